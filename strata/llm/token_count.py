"""Token counts of a unigram vocabulary by count-only Viterbi.

An Aho-Corasick automaton over the vocabulary lists all pieces that end at
each character; dynamic programming over those ends carries only the best score
and the piece count of the best segmentation, no back pointers.  Tie rules are
those of the public unigram encoders: a segmentation replaces another at the
same end only if its score is strictly greater, starts being tried from left to
right, so of equal scores the longest last piece stays; a character that no
single-character piece covers may also be an unknown, scored 10 below the
lowest score and tried after the pieces from the same start.  Scores are summed
as doubles, left to right.

With byte fallback an unknown character counts as many tokens as it has UTF-8
bytes, otherwise a run of unknowns counts one.

Text is prepared as the vocabulary's own normaliser does (spaces made visible,
one put in front).  If no piece holds a visible space after another character,
every path passes such a place, so the text is cut there and each distinct
segment is solved once per task; the memory is emptied at a fixed size.  Cutting
is exact while sums are exact, as they are for this vocabulary's integer scores.

Defined results: null and empty texts have no tokens and score 0; texts of any
length are counted whole; repeated rows give repeated results; an empty table
gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
UNKNOWN_PENALTY = 10.0


@dataclass
class Vocabulary:
    """Pieces with scores; ``fallback``: unknown characters become bytes."""

    scores: dict[str, float]
    fallback: bool = True
    prefix: bool = True
    lowest: float | None = None       # of all entries, also those that never match

    @staticmethod
    def from_model(path: str) -> Vocabulary:
        from sentencepiece import sentencepiece_model_pb2 as pb
        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        usual = {p.piece: p.score for p in proto.pieces if p.type == 1}
        return Vocabulary(usual, proto.trainer_spec.byte_fallback, proto.normalizer_spec.add_dummy_prefix,
                          min(usual.values()))


@dataclass
class Counter:
    vocab: Vocabulary
    memory: int = 300_000
    known: dict[str, tuple[int, int, float]] = field(default_factory=dict)

    def __post_init__(self):
        import ahocorasick
        self.auto = ahocorasick.Automaton()
        for p, s in self.vocab.scores.items():
            self.auto.add_word(p, (len(p), float(s)))
        self.auto.make_automaton()
        low = self.vocab.lowest if self.vocab.lowest is not None else min(self.vocab.scores.values())
        self.unknown = float(low) - UNKNOWN_PENALTY
        # integer scores add up exactly and in any order: only then cut
        exact = all(float(s).is_integer() for s in self.vocab.scores.values())
        inside = any(SPACE in p.lstrip(SPACE) for p in self.vocab.scores)
        self.cut = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+") if exact and not inside else None

    def viterbi(self, text: str) -> tuple[int, int, float]:
        """(tokens, unknown characters, best score) of a prepared text."""
        n = len(text)
        best: list[float] = [0.0] + [float("-inf")] * n
        count = [0] * (n + 1)
        unknown = [0] * (n + 1)
        tail = [False] * (n + 1)             # the best path ends in an unknown
        done = 0                             # ends settled so far
        fallback, floor = self.vocab.fallback, self.unknown

        def settle(end: int, pieces: list[tuple[int, float]]) -> None:
            top, src, single = float("-inf"), -1, False
            for size, score in pieces:
                start = end - size
                s = best[start] + score
                if s > top or s == top and start < src:
                    top, src = s, start
                single = single or size == 1
            if not single:
                s = best[end - 1] + floor
                if src < 0 or s > top:       # tried last: only a greater score wins
                    best[end] = s
                    unknown[end] = unknown[end - 1] + 1
                    count[end] = count[end - 1] + (len(text[end - 1].encode()) if fallback else not tail[end - 1])
                    tail[end] = True
                    return
            best[end], count[end], unknown[end] = top, count[src] + 1, unknown[src]

        pending: list[tuple[int, float]] = []
        at = 0
        for last, piece in self.auto.iter(text):
            if last + 1 != at:
                if at:
                    settle(at, pending)
                    done = at
                while done < last:
                    done += 1
                    settle(done, [])
                at, pending = last + 1, []
            pending.append(piece)
        if at:
            settle(at, pending)
            done = at
        while done < n:
            done += 1
            settle(done, [])
        return count[n], unknown[n], best[n]

    def segment(self, seg: str) -> tuple[int, int, float]:
        got = self.known.get(seg)
        if got is None:
            got = self.viterbi(seg)
            if len(seg) <= 64:
                if len(self.known) >= self.memory:
                    self.known.clear()
                self.known[seg] = got
        return got

    def text(self, text: str | None) -> tuple[int, int, float]:
        if not text:
            return 0, 0, 0.0
        prepared = (SPACE if self.vocab.prefix else "") + text.replace(" ", SPACE)
        if self.cut is None or not self.vocab.fallback:       # runs of unknowns may cross a cut
            return self.viterbi(prepared)
        tokens = unknown = 0
        score = 0.0
        for t, u, s in map(self.segment, self.cut.findall(prepared)):
            tokens += t
            unknown += u
            score += s
        return tokens, unknown, score


_COUNTERS: dict[int, Counter] = {}


def count_tokens(docs: DataFrame, vocab: Vocabulary, id_col: str = "doc_id", text_col: str = "text",
                 carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, *carry, n_tokens bigint, n_unknown bigint, best_score double), one
    row per input row.  The vocabulary (a fixed size) travels with the code."""
    keep = [id_col, *carry]
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    mark = hash((tuple(sorted(vocab.scores.items())), vocab.fallback, vocab.prefix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if mark not in _COUNTERS:
            _COUNTERS.clear()
            _COUNTERS[mark] = Counter(vocab)
        counter = _COUNTERS[mark]
        for b in batches:
            got = [counter.text(t) for t in b.column("__text").to_pylist()]
            cols = [pa.array([g[i] for g in got], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *cols],
                                             names=[*keep, "n_tokens", "n_unknown", "best_score"])

    return (docs.select(*keep, F.col(text_col).alias("__text"))
            .mapInArrow(run, f"{kinds}, n_tokens bigint, n_unknown bigint, best_score double"))
