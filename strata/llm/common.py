"""Helpers shared by the training-data operators.

Conventions of this subpackage:

* operators read only the columns they name and return only their own
  columns, so extra input columns with clashing names are harmless;
* a null text is an empty text; a null id sorts after every other id (it is
  never the "smaller" one) and comes back as null;
* equal ids with different texts are told apart by the text's hash;
* tables used more than once are written to the shared folder that the
  session names in ``spark.checkpoint.dir`` and read back, which also cuts
  lineage, so a lost executor costs one re-read and not the whole job.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

DOC_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
NULL_ID = 2**63 - 1          # order key of a null id: after every real id


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


FILE_ROWS = 1_000_000
BATCH = 1_000                # whole texts sent to a Python worker at a time


def files_for(df: DataFrame) -> int:
    """A file per million rows of ``df`` (a stored table): small tables of many rounds are not cut in many files."""
    return 1 + df.count() // FILE_ROWS


def stage(df: DataFrame, name: str, batch_rows: int | None = None, files: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back (the folder belongs to the platform, which also clears it).  With
    ``batch_rows`` Python workers get at most that many rows at a time while it
    is written: whole texts are copied several times on their way.  With
    ``files`` it is written by at most that many tasks."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{uuid.uuid4().hex}/{name}"
    schema = df.schema
    before = spark.conf.get(ARROW_ROWS)
    try:
        if batch_rows:
            spark.conf.set(ARROW_ROWS, str(min(batch_rows, int(before)) if int(before) > 0 else batch_rows))
        (df.coalesce(files) if files else df).write.parquet(path)
    finally:
        spark.conf.set(ARROW_ROWS, before)
    return spark.read.schema(schema).parquet(path)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_key(col) -> F.Column:
    """Order key of a nullable id."""
    return F.coalesce(col, F.lit(NULL_ID))


def id_back(col) -> F.Column:
    return F.when(col != F.lit(NULL_ID), col)


def key_of(id_name: str, value: F.Column) -> F.Column:
    """A never-null string key for a nullable id (for joins that must also
    match null with null without changing the partitioning)."""
    return F.coalesce(F.concat(F.lit("v"), value.cast("string")), F.lit("n")).alias(id_name)


class WordHash(dict):
    """word bytes -> 64-bit hash, cached; the cache is emptied when it holds
    ``limit`` words, so a task's memory does not follow the vocabulary."""

    def __init__(self, seed: int = 0, limit: int = 1 << 20):
        super().__init__()
        self.seed, self.limit = seed, limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, self.seed)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


class Memory:
    """Values of strings (never None), about ``limit`` of them: new ones go into the young half, which
    becomes the old half when full; strings met again come back from it."""

    def __init__(self, limit: int):
        self.limit = limit
        self.young: dict = {}
        self.old: dict = {}

    def fetch(self, strings: list[str], learn: Callable[[list[str]], Iterable]) -> list:
        got = list(map(self.young.get, strings))
        holes = [k for k, v in enumerate(got) if v is None]
        for k in holes:
            got[k] = self.old.get(strings[k])
        new = [k for k in holes if got[k] is None]
        for k, v in zip(new, learn([strings[k] for k in new]), strict=True):
            got[k] = v
        self.young.update((strings[k], got[k]) for k in holes)
        if len(self.young) > self.limit // 2:
            self.old, self.young = self.young, {}
        return got


def blocks(batch: pa.RecordBatch, rows: int = 1_000) -> Iterator[pa.RecordBatch]:
    """Parts of a batch, for work whose temporary arrays are many times its rows."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift-multiply)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class RollingHash:
    """Hashes of word spans from prefix sums of ``x[i] * B**i`` modulo 2**64
    (``B`` odd, so it can be divided out again)."""

    BASE = 0xD6E8FEB86659FD93

    def __init__(self):
        self.pow = self.inv = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if n >= len(self.pow):
            size = max(2 * len(self.pow), n + 1, 1024)
            for name, base in (("pow", self.BASE), ("inv", pow(self.BASE, -1, 1 << 64))):
                a = np.full(size, base, np.uint64)
                a[0] = 1
                setattr(self, name, np.multiply.accumulate(a))

    def prefix(self, x: np.ndarray) -> np.ndarray:
        self._grow(len(x))
        out = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(x * self.pow[: len(x)], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((prefix[end] - prefix[start]) * self.inv[start])

    def grams(self, prefix: np.ndarray, k: int) -> np.ndarray:
        n = len(prefix) - k
        return mix64((prefix[k:] - prefix[:n]) * self.inv[:n])


def sliding_argmin(a: np.ndarray, w: int) -> np.ndarray:
    """Leftmost position of the minimum of each run of ``w`` values, by
    doubling (log2 w vector steps)."""
    pos = np.arange(len(a), dtype=np.int64)
    have = 1
    while have < w:
        step = min(have, w - have)
        left, right = pos[:-step], pos[step:]
        pos = np.where(a[right] < a[left], right, left)
        have += step
    return pos


def arrow_rows(fn: Callable[..., Iterable[tuple]], schema: pa.Schema, flush: int = 20_000) -> Callable:
    """``mapInArrow`` function from a per-row generator ``fn(*row) -> rows``;
    output batches are cut at ``flush`` rows or about 32 MB."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True):
                for r in fn(*row):
                    out.append(r)
                    size += 64 + sum(len(v) for v in r if isinstance(v, (bytes, str, list)))
                    if len(out) >= flush or size > 32_000_000:
                        yield _batch(out, schema)
                        out, size = [], 0
        if out:
            yield _batch(out, schema)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)
