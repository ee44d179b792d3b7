r"""WARC archives: writing, and reading with boundary-chain verification.

Writing is Spark's text sink with the record terminator as line separator: one
record (header, HTTP header, payload) is one value, so archives are written
task by task to any file system Spark knows, with its commit protocol.  Of
records with equal payloads the one with the largest page id is a response,
the others are revisits that name it and carry no payload.

Reading is Spark's text source with the record magic as line separator, so
archives are split at any byte and every piece between two magics is a
candidate record, wherever a task's range begins.  Piece lengths summed per
range, then per file, give each candidate's byte offset; its header gives the
offset where its successor must stand.  A magic inside a payload also makes a
candidate.  Pointer jumping from offset 0 of every file doubles the distance
covered each round and keeps only candidates that the chain reaches.  Records
whose payload holds the magic are put together again from their pieces.

Defined results: a null payload is empty; a null url is left out; line breaks
in a url are percent-encoded; a null page id is left out, comes back as null and
is never preferred as the response while another id has the payload; rows that
repeat the response's id and payload are responses too; an empty table writes
no record and reads back empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import stage

MAGIC, TERMINATOR, BREAK = "WARC/1.1\r\n", "\r\n\r\n", "\r\n"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS_PER_FILE = 16384
LEAST_ID = -(2**63)
BROADCAST_ROWS = 500_000              # revisits (of about 60 bytes) sent to every executor at most


def base32_sha1(hex_digest) -> F.Column:
    """Upper-case base32 of a SHA-1 given in hex: 5 bits a letter, 8 letters
    for every 10 hex digits."""
    letters = []
    for g in range(4):
        word = F.conv(F.substring(hex_digest, 10 * g + 1, 10), 16, 10).cast("bigint")
        for j in range(8):
            at = F.shiftright(word, 35 - 5 * j).bitwiseAND(F.lit(31)).cast("int") + 1
            letters.append(F.substr(F.lit(ALPHABET), at, F.lit(1)))
    return F.concat(*letters)


def _urn(hex_digest) -> F.Column:
    parts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(hex_digest, a, n) for a, n in parts]), F.lit(">"))


def _record_id(page_id, sha) -> F.Column:
    return _urn(F.sha1(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("")), sha).cast("binary")))


def warc_records(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
                 payload_col: str = "html", date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """(value): one record per row, without the terminator."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(LEAST_ID)).alias("id"),
                        F.col(url_col).alias("url"), payload.alias("payload"))
    sha = F.sha1(F.col("payload").cast("binary"))
    light = rows.select("id", sha.alias("sha"), F.octet_length("payload").alias("n")).filter(F.col("n") >= min_bytes)
    groups = light.groupBy("sha").agg(F.max("id").alias("last"), F.count(F.lit(1)).alias("of"))
    revisits = stage(light.join(groups.filter("of > 1"), "sha").filter("id < last")
                     .select("id", "sha", "last").distinct(), "revisits")
    if revisits.count() <= BROADCAST_ROWS:               # else payloads are shuffled to their revisits
        revisits = F.broadcast(revisits)
    rows = rows.withColumn("sha", sha).join(revisits, ["id", "sha"], "left")
    is_revisit = F.col("last").isNotNull()
    page = F.when(F.col("id") != LEAST_ID, F.col("id"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length("payload").cast("string"), F.lit(TERMINATOR))
    block = F.when(is_revisit, http).otherwise(F.concat(http, F.col("payload")))

    def field(name, value):
        return F.concat(F.lit(f"{name}: "), value, F.lit(BREAK))

    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    first = F.when(F.col("last") != LEAST_ID, F.col("last"))
    parts = [F.lit(MAGIC), field("WARC-Type", F.when(is_revisit, F.lit("revisit")).otherwise(F.lit("response"))),
             field("WARC-Record-ID", _record_id(page, F.col("sha"))), field("WARC-Date", F.lit(date)),
             F.coalesce(field("WARC-Target-URI", url), F.lit("")), F.coalesce(field("X-Page-ID", page.cast("string")), F.lit("")),
             field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("sha")))),
             F.when(is_revisit, F.concat(field("WARC-Profile", F.lit(PROFILE)),
                                         field("WARC-Refers-To", _record_id(first, F.col("sha"))))).otherwise(F.lit("")),
             F.lit("Content-Type: application/http; msgtype=response\r\n"),
             field("Content-Length", F.octet_length(block).cast("string")), F.lit(BREAK), block]
    return rows.select(F.concat(*parts).alias("value"))


def write_warc(pages: DataFrame, path: str, min_bytes: int = 0, records_per_file: int = RECORDS_PER_FILE, **columns) -> None:
    (warc_records(pages, min_bytes, **columns).write.option("lineSep", TERMINATOR)
     .option("maxRecordsPerFile", records_per_file).text(path))


# -- reading -----------------------------------------------------------------
def _pieces(spark, path: str) -> DataFrame:
    """(file, split, nth, value, len): what stands between two magics."""
    return (spark.read.option("lineSep", MAGIC).text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                    F.monotonically_increasing_id().alias("nth"), "value",
                    F.octet_length("value").cast("bigint").alias("len")))


def _offsets(pieces: DataFrame) -> DataFrame:
    """Add ``at``, the offset of the magic before each piece (negative for what
    stands before the first magic of a file)."""
    step = F.col("len") + len(MAGIC)
    sums = pieces.groupBy("file", "split").agg(F.sum(step).alias("size"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("file", "split", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("file", "split").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (pieces.withColumn("to", F.sum(step).over(within)).join(base, ["file", "split"])
            .withColumn("at", F.col("base") + F.col("to") - step - len(MAGIC)).drop("to", "base"))


def _parsed(df: DataFrame) -> DataFrame:
    """Read the header of ``value`` and, where its block is whole, the payload."""
    header = F.substring_index("value", TERMINATOR, 1)
    df = df.withColumn("header", F.when(F.instr("value", F.lit(TERMINATOR)) > 0, header))

    def field(name):
        got = F.regexp_extract("header", rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1)
        return F.when(got != "", got)

    df = df.withColumn("size", F.when(
        field("Content-Length").rlike("^[0-9]{1,15}$"), field("Content-Length").try_cast("bigint")))
    df = df.withColumn("skip", F.octet_length("header") + len(TERMINATOR))
    # a candidate: a header with a length; whole: its block and terminator are in this piece
    df = df.withColumn("whole", F.col("size").isNotNull() & (F.octet_length("value") >= F.col("skip") + F.col("size")))
    raw = F.col("value").cast("binary")
    df = df.withColumn("block", F.when(F.col("whole"), F.substr(raw, F.col("skip") + 1, F.col("size").cast("int"))))
    http = F.octet_length(F.substring_index(F.col("block").cast("string"), TERMINATOR, 1)) + len(TERMINATOR)
    df = df.withColumn("payload", F.when(F.col("whole"), F.substr("block", http + 1, F.greatest(F.octet_length("block") - http, F.lit(0)))))
    return df.select(
        *[c for c in df.columns if c in ("file", "split", "nth", "len", "at")], "size", "skip", "whole",
        field("WARC-Type").alias("kind"), field("WARC-Record-ID").alias("record_id"),
        field("WARC-Refers-To").alias("refers_id"), field("WARC-Target-URI").alias("url"),
        field("X-Page-ID").try_cast("bigint").alias("page_id"),
        F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("said_digest"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.when(F.col("whole"), base32_sha1(F.sha1("payload"))).alias("payload_digest"), F.col("payload"))


def reached(candidates: DataFrame) -> DataFrame:
    """(file, at) of the candidates on the chain from offset 0 of their file;
    ``candidates``: (file, at, to).  Every round doubles the jumps."""
    t = stage(candidates.withColumn("on", F.col("at") == 0), "chain")
    while True:
        nxt = t.select("file", F.col("at").alias("to"), F.col("to").alias("to2"))
        marks = t.filter("on").select("file", F.col("to").alias("at"), F.lit(True).alias("hit"))
        jumped = (t.join(nxt, ["file", "to"], "left").select("file", "at", F.col("to2").alias("to"), "on")
                  .join(marks, ["file", "at"], "left")
                  .select("file", "at", "to", (F.col("on") | F.coalesce("hit", F.lit(False))).alias("on")).distinct())
        t = stage(jumped, "chain")
        if t.filter("to is not null").isEmpty():
            return t.filter("on").select("file", "at")


def read_warc(spark, path: str, payloads: bool = False) -> DataFrame:
    """(file, at, kind, record_id, refers_id, url, page_id, said_digest,
    payload_bytes, payload_digest[, payload]) of the verified records; length
    and digest are those of the payload as read."""
    light = stage(_parsed(_pieces(spark, path)).drop("payload"), "pieces")
    placed = stage(_offsets(light).filter("size is not null"), "candidates")
    end = F.col("at") + len(MAGIC) + F.col("skip") + F.col("size") + len(TERMINATOR)
    chain = reached(placed.select("file", "at", end.alias("to")))
    records = placed.join(chain, ["file", "at"])
    names = ["file", "at", "kind", "record_id", "refers_id", "url", "page_id", "said_digest", "payload_bytes", "payload_digest"]
    if not payloads and records.filter("not whole").isEmpty():
        return records.select(names)
    # payloads that hold the magic (or all, if payloads are asked for): join the pieces of each record
    want = records.select("file", "at") if payloads else records.filter("not whole").select("file", "at")
    pieces = _offsets(_pieces(spark, path).join(want.select("file").distinct(), "file", "left_semi"))
    of_file = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    owned = (pieces.join(chain.withColumn("owner", F.col("at")), ["file", "at"], "left")
             .withColumn("owner", F.last("owner", ignorenulls=True).over(of_file))
             .join(want.withColumnRenamed("at", "owner"), ["file", "owner"], "left_semi"))
    joined = (owned.groupBy("file", F.col("owner").alias("at"))
              .agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("p"))
              .select("file", "at", F.concat_ws(MAGIC, F.transform("p", lambda x: x["value"])).alias("value")))
    mended = _parsed(joined)
    if payloads:
        return mended.select(*names, "payload")
    return records.filter("whole").select(names).unionByName(mended.select(names))


def archive_round_trip(pages: DataFrame, min_bytes: int = 0, path: str | None = None) -> DataFrame:
    """Write ``pages`` as archives (to the shared folder if no path is given),
    read them back and resolve revisits: (page_id, url, payload_bytes,
    payload_digest, record_type, refers_to)."""
    spark = pages.sparkSession
    path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{uuid.uuid4().hex}/warc"
    write_warc(pages, path, min_bytes)
    records = stage(read_warc(spark, path), "records")
    responses = records.filter("kind = 'response'")
    full = responses.groupBy(F.col("record_id").alias("refers_id")).agg(
        F.max("page_id").alias("refers_to"), F.max("payload_bytes").alias("full_bytes"))
    revisits = records.filter("kind = 'revisit'").join(full, "refers_id", "left")
    columns = ["page_id", "url", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), "refers_to"]
    return (responses.withColumn("refers_to", F.lit(None).cast("bigint")).select(columns)
            .unionByName(revisits.drop("payload_bytes", "payload_digest")
                         .withColumnsRenamed({"full_bytes": "payload_bytes", "said_digest": "payload_digest"}).select(columns)))
