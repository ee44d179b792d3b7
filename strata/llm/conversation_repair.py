"""Conversation structure repair: the cheapest edits that give turns of the form
``(s?(ua)+)?`` by iterative-deepening A*.

Rows of a conversation are read by turn (nulls first).  A row's first fault
counts: *blank* (no character but ASCII white space), *duplicate* (role and text
seen earlier), *truncated* (the last such character is not one of ``.!?``).
Edits: Keep 0, Rerole to user or assistant 3, Delete 4 (the only edit of blank
and duplicate rows), Insert an empty user or assistant turn 3; a truncated row
that stays costs 3 more.  Of equally cheap edit sequences the one whose initials
come first in ASCII is taken.

The state after an edit is what the last kept turn was (nothing, system, user,
assistant), so an initial tells which role an insert or rerole gives.  The search
goes depth first in ASCII order of the initials under a cost bound; a table keeps,
per (row, state), the least cost still needed that failed searches have proven,
which prunes later visits and is the next bound.  The first path found is the answer.

Scale: rows are range-partitioned by conversation, turn, role and text, so the
rows of one conversation may lie in many partitions.  A task cuts its sorted rows
into blocks of at most ``BLOCK_ROWS`` rows or ``BLOCK_BYTES`` of text.  A
conversation that is one block inside a task is solved there.  Any other is solved
per block for each pair of states before and after it (at most 16 searches); the
state pairs of its blocks, without texts, are then chained from the end (cheapest
rest) and from the start (the states passed), and each block's turns are rewritten
in parallel.  An edit sequence of a block ends with one of its rows, so none is
the beginning of another and the blocks' choices make the whole choice.

Defined results: null role and text are one space; a role without characters fits
no place (delete or rerole it); equal turns are ordered by the first 64 characters
of the role, the first 256 of the text, then the SHA-256 of both; repeated rows are
aggregated before any row is moved and become one row with a count; null ids are
one conversation; a conversation whose rows all have ``copies`` 0 is returned with
zeros; an empty table gives no rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from .common import key_of, stage

BLOCK_ROWS = 32
BLOCK_BYTES = 1 << 20
KEEP, REROLE, DELETE, INSERT, SHORT = 0, 3, 4, 3, 3        # costs of the edits; of a truncated row that stays
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
WHITE = " \t\n\x0b\x0c\r"
NEVER = 1 << 62

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: the role that an insert or rerole gives, and the state after it
NEED = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
FITS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
LEGAL = {"su", "ua", "au"}
#: inserts that end a conversation in each state
CLOSING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}


class Search:
    """Depth-first searches over ``rows`` (role initial, fault, copies) that end in
    state ``goal``; None is the end of the conversation, where inserts may still
    follow the last row.  What failed searches prove holds for every start."""

    def __init__(self, rows: list[tuple[str, int, int]], goal: int | None):
        self.rows, self.goal = rows, goal
        n = self.n = len(rows)
        rest = [0] * (n + 1)
        for i in range(n - 1, -1, -1):
            _, fault, copies = rows[i]
            rest[i] = rest[i + 1] + DELETE * (copies - 1) + (DELETE if fault in (BLANK, DUPLICATE) else SHORT if fault else 0)
        self.proven = [[r] * 4 for r in rest]            # no cheaper way on from (row, state)
        if goal is not None:
            self.proven[n] = [0 if s == goal else NEVER for s in STATES]
        self.most = rest[0] + 4 * n + 9                  # deleting every row and inserting what is missing costs less

    def reachable(self, start: int) -> bool:
        if self.goal == SYSTEM and start == START:
            return any(initial == "s" and fault not in (BLANK, DUPLICATE) for initial, fault, _ in self.rows)
        if not self.rows and self.goal is not None:
            return start == self.goal
        return self.goal is None or self.goal >= start or (start, self.goal) == (ASSISTANT, USER)

    def best(self, start: int) -> tuple[int, str] | None:
        """Cheapest (cost, edit initials) from ``start``, or None."""
        if not self.reachable(start):
            return None
        path: list[str] = []
        bound = self.proven[0][start]
        while bound <= self.most:
            if self._down(0, start, bound, path):
                return bound, "".join(path)
            bound = self.proven[0][start]
        return None

    def _down(self, i: int, state: int, left: int, path: list[str]) -> bool:
        proven = self.proven
        if proven[i][state] > left:
            return False
        if i == self.n and (self.goal is not None or state in (START, ASSISTANT)):
            return True
        least = NEVER
        for edit, cost, j, after in self._edits(i, state):
            path.append(edit)
            if self._down(j, after, left - cost, path):
                return True
            path.pop()
            least = min(least, cost + proven[j][after])
        proven[i][state] = max(proven[i][state], least)
        return False

    def _edits(self, i: int, state: int):
        """(initials, cost, next row, next state) in ASCII order."""
        need = NEED[state][1]
        if i == self.n:
            yield "I", INSERT, i, need
            return
        initial, fault, copies = self.rows[i]
        again = "D" * (copies - 1)
        yield "D" + again, DELETE * copies, i + 1, state
        yield "I", INSERT, i, need
        if fault not in (BLANK, DUPLICATE):
            stay = DELETE * (copies - 1) + (SHORT if fault else 0)
            if (state, initial) in FITS:
                yield "K" + again, KEEP + stay, i + 1, FITS[state, initial]
            yield "R" + again, REROLE + stay, i + 1, need


def rewrite(rows: list[tuple[str, str, int]], audit: str, state: int) -> tuple[list[tuple[str, str]], int]:
    """The turns that the edits ``audit`` make of ``rows`` (role, text, copies),
    and the state after them."""
    out, at = [], 0

    def inserts():
        nonlocal at, state
        while audit[at:at + 1] == "I":
            out.append((NEED[state][0], ""))
            state = NEED[state][1]
            at += 1

    for role, text, copies in rows:
        inserts()
        edit = audit[at]
        if edit == "K":
            out.append((role, text))
            state = FITS[state, role[:1]]
        elif edit == "R":
            out.append((NEED[state][0], text))
            state = NEED[state][1]
        at += copies                                     # the copies after the first are deleted
    inserts()
    return out, state


_TURN = "array<struct<role:string,text:string>>"
_STATS = "blank bigint, duplicate bigint, truncated bigint, illegal bigint, turn_lo bigint, turn_hi bigint, turns bigint"


class _Block:
    """Rows (turn, role, text, copies, fault) of one conversation in reading order."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.size = 0

    def add(self, row: tuple) -> None:
        self.rows.append(row)
        self.size += 64 + 4 * (len(row[1]) + len(row[2]))

    @property
    def full(self) -> bool:
        return len(self.rows) >= BLOCK_ROWS or self.size >= BLOCK_BYTES

    def units(self):
        return [(role[:1], fault, copies) for _, role, _, copies, fault in self.rows]

    def stats(self) -> dict:
        count = [0, 0, 0, 0]
        illegal, last, turns, seen = 0, None, 0, None
        known = [r[0] for r in self.rows if r[0] is not None]
        for turn, role, _, copies, fault in self.rows:
            first = role[:1]
            if fault == BLANK:
                count[BLANK] += copies
            else:
                count[fault] += 1
                count[DUPLICATE] += copies - 1
            illegal += (last is not None and last + first not in LEGAL) + (copies - 1)
            last = first
            if turn is not None and turn != seen:
                turns += 1
                seen = turn
        return {"blank": count[BLANK], "duplicate": count[DUPLICATE], "truncated": count[TRUNCATED], "illegal": illegal,
                "turn_lo": min(known, default=None), "turn_hi": max(known, default=None), "turns": turns}


def _solve_blocks(schema: pa.Schema):
    """Sorted rows of a range partition -> solved conversations and blocks."""

    def run(batches):
        pid = TaskContext.get().partitionId()
        out: list[dict] = []
        size, seq, first_conversation = 0, 0, True
        conv, block, closed, cut = None, None, True, False

        def solved(b: _Block) -> dict:
            cost, audit = Search(b.units(), None).best(START)
            turns, _ = rewrite([r[1:4] for r in b.rows], audit, START)
            return {"whole": True, "cost": cost, "audit": audit, "turns_out": turns}

        def pairs(b: _Block) -> dict:
            units = b.units()
            to = [Search(units, t) for t in STATES]
            ways = [to[t].best(s) for s in STATES for t in STATES]
            order = [t for s in STATES for t in sorted(STATES, key=lambda t: ways[4 * s + t][1] if ways[4 * s + t] else "~")]
            return {"whole": False, "costs": [w[0] if w else NEVER for w in ways], "audits": [w[1] if w else None for w in ways],
                    "order": order, "turns_out": [(r[1], r[2]) for r in b.rows], "copies": [r[3] for r in b.rows],
                    "first_role": b.rows[0][1][:1] if b.rows else None, "last_role": b.rows[-1][1][:1] if b.rows else None}

        def emit(b: _Block, whole: bool) -> None:
            nonlocal seq, size
            out.append({"conv_id": conv, "pid": pid, "seq": seq} | b.stats() | (solved(b) if whole else pairs(b)))
            seq += 1
            size += b.size

        for batch in batches:
            for new, turn, role, text, copies, fault in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if closed or new != conv:
                    if not closed:
                        emit(block, whole=not first_conversation and not cut)
                        first_conversation = False
                    conv, block, cut, closed = new, _Block(), False, False
                if block.full:
                    cut = True
                    emit(block, whole=False)
                    block = _Block()
                if copies:
                    block.add((turn, role, text, copies, fault))
                if len(out) >= 5_000 or size > 16_000_000:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out, size = [], 0
        if not closed:
            emit(block, whole=False)                     # the last conversation may go on in the next partition
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _backward(schema: pa.Schema):
    """Blocks from the last to the first: for each state before a block the state
    after it on the cheapest way to the end."""

    def run(batches):
        key, rest = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                last = row["ck"] != key
                if last:
                    key, rest = row["ck"], [INSERT * len(CLOSING[s]) for s in STATES]
                costs, order = row.pop("costs"), row.pop("order")
                best, after = [], []
                for s in STATES:
                    # the first in ASCII order of those that cost least
                    t = min(order[4 * s: 4 * s + 4], key=lambda t: costs[4 * s + t] + rest[t])
                    best.append(min(NEVER, costs[4 * s + t] + rest[t]))
                    after.append(t)
                rest = best
                out.append(row | {"after": after, "last": last})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _forward(schema: pa.Schema):
    """Blocks from the first to the last: the states passed, and what counts
    across a block's start."""

    def run(batches):
        key, state, role, turn = None, START, None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["ck"] != key:
                    key, state, role, turn = row["ck"], START, None, None
                after = row["after"][state]
                edge = role is not None and row["first_role"] is not None and role + row["first_role"] not in LEGAL
                same = turn is not None and row["turn_lo"] == turn
                out.append({"pid": row["pid"], "seq": row["seq"], "before": state, "then": after, "last": row["last"],
                            "edge": int(edge), "same_turn": int(same)})
                state = after
                role = row["last_role"] if row["last_role"] is not None else role
                turn = row["turn_hi"] if row["turn_hi"] is not None else turn
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _rewrite_blocks(schema: pa.Schema):
    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                way = 4 * r["before"] + r["then"]
                audit, cost = r["audits"][way], r["costs"][way]
                if r["last"]:
                    audit += CLOSING[r["then"]]
                    cost += INSERT * len(CLOSING[r["then"]])
                turns, _ = rewrite([(t["role"], t["text"], n) for t, n in zip(r["turns_out"], r["copies"], strict=True)],
                                   audit, r["before"])
                out.append({k: r[k] for k in ("conv_id", "pid", "seq", "blank", "duplicate", "truncated", "turn_lo", "turn_hi")}
                           | {"illegal": r["illegal"] + r["edge"], "turns": r["turns"] - r["same_turn"], "single": False,
                              "cost": cost, "audit": audit, "repaired": turns})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _with_id(ddl: str, conv: StructField) -> StructType:
    return StructType([conv, *StructType.fromDDL(ddl).fields])


def repair_conversations(rows: DataFrame, copies: str | None = None) -> DataFrame:
    """Repaired conversations of ``rows`` (conv_id, turn, role, text), in parts.

    ``copies``: column with the number of times a row stands (0: not at all, but
    its conversation is returned).  A row of the result is a part of a
    conversation: conv_id, pid and seq (the parts' order), single (the only part),
    blank, duplicate, truncated, illegal, turn_lo, turn_hi, turns (distinct turns
    that begin in the part), cost, audit (edit initials) and repaired (array of
    role, text).  Sums and joined strings over the parts are the conversation's."""
    text, role = (F.coalesce(F.col(c), F.lit(" ")) for c in ("text", "role"))
    base = rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"),
                       (F.col(copies) if copies else F.lit(1)).cast("bigint").alias("n"))
    gone = F.col("n") == 0
    base = base.withColumns({"role": F.when(gone, "").otherwise(F.col("role")), "text": F.when(gone, "").otherwise(F.col("text"))})
    mark = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    base = base.select("*", key_of("ck", F.col("conv_id")), key_of("tk", F.col("turn")),
                       F.when(gone, F.lit(b"")).otherwise(F.unhex(F.sha2(mark.cast("binary"), 256))).alias("h"))

    # only hashes move: rows that stand more than once, and the first turn of what stands in several turns
    counted = base.groupBy("ck", "tk", "h").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("c"), F.first("turn").alias("turn"))
    again = stage(counted.filter("c > 1").select("ck", "tk", "h", "total"), "again")
    first = stage(counted.filter("total > 0").groupBy("ck", "h")
                  .agg(F.min("turn").alias("first_turn"), F.max(F.isnull("turn")).alias("has_null"), F.count(F.lit(1)).alias("c"))
                  .filter("c > 1").drop("c"), "first")
    marked = base.join(again, ["ck", "tk", "h"], "left")
    names = ["conv_id", "turn", "role", "text", "n", "ck", "h"]
    once = marked.filter(F.col("total").isNull()).select(names)
    more = (marked.filter(F.col("total").isNotNull()).groupBy("ck", "tk", "h")
            .agg(*[F.first(c).alias(c) for c in ("conv_id", "turn", "role", "text")], F.first("total").alias("n")).select(names))
    distinct = once.unionByName(more).join(first, ["ck", "h"], "left")
    earlier = F.col("turn").isNotNull() & (F.col("has_null") | (F.col("turn") > F.col("first_turn")))
    bare = F.rtrim("text", F.lit(WHITE))
    fault = (F.when(bare == "", BLANK).when(F.coalesce(earlier, F.lit(False)), DUPLICATE)
             .when(~F.substring(bare, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(0))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.substring("role", 1, 64),
             F.substring("text", 1, 256), F.col("h")]
    lines = (distinct.select("conv_id", "turn", "role", "text", "n", fault.alias("fault"), "h")
             .repartitionByRange(*order).sortWithinPartitions(*order).drop("h"))

    conv = StructField("conv_id", rows.schema["conv_id"].dataType)
    found = _with_id(f"pid int, seq int, whole boolean, {_STATS}, cost bigint, audit string, costs array<bigint>, "
                     "audits array<string>, `order` array<int>, first_role string, last_role string, "
                     f"turns_out {_TURN}, copies array<bigint>", conv)
    solved = stage(lines.mapInArrow(_solve_blocks(to_arrow_schema(found)), found), "solved")
    part = _with_id(f"pid int, seq int, single boolean, {_STATS}, cost bigint, audit string, repaired {_TURN}", conv)
    single = solved.filter("whole").select([F.col({"single": "whole", "repaired": "turns_out"}.get(f.name, f.name)).alias(f.name)
                                            for f in part])

    blocks = solved.filter("NOT whole")
    back = StructType.fromDDL("ck string, pid int, seq int, turn_lo bigint, turn_hi bigint, first_role string, last_role string, "
                              "after array<int>, last boolean")
    passed = StructType.fromDDL("pid int, seq int, before int, then int, last boolean, edge int, same_turn int")
    compact = blocks.select(key_of("ck", F.col("conv_id")), "pid", "seq", "turn_lo", "turn_hi", "first_role", "last_role", "costs", "order")
    backward = stage(compact.repartition("ck").sortWithinPartitions("ck", F.desc("pid"), F.desc("seq"))
                     .mapInArrow(_backward(to_arrow_schema(back)), back), "backward")
    forward = stage(backward.repartition("ck").sortWithinPartitions("ck", "pid", "seq")
                    .mapInArrow(_forward(to_arrow_schema(passed)), passed), "forward")
    split = blocks.join(forward, ["pid", "seq"]).mapInArrow(_rewrite_blocks(to_arrow_schema(part)), part)
    return single.unionByName(split)
