"""Query and DuckDB SQL of the conversation repair operator.

The query damages every row by a rule on its key, repairs the conversations and
derives counts and digests from the operator's parts."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from .common import key_of, table
from .conversation_repair import repair_conversations


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after damage, with the number of ``copies`` (0: dropped).  Nulls are
    one space, in the key of the rule, in role and in text."""
    space = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.concat(space["conv_id"], F.lit(":"), space["turn"]).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", space["role"].alias("role"), space["text"].alias("text"), kind.alias("kind"))
    text = (F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("copies"))


_SUMS = ("blank", "duplicate", "truncated", "illegal", "cost")


def _digests(schema: pa.Schema):
    """Parts in their order -> a row per conversation, by running sums and a
    running SHA-256; a task holds one batch of parts."""

    def run(batches):
        key, state = None, None

        def done():
            lo, hi, turns = state["lo"], state["hi"], state["turns"]
            return {"conv_id": state["conv_id"], "gaps": hi - lo + 1 - turns if turns else 0,
                    **{c: state[c] for c in _SUMS}, "audit": "".join(state["audit"]), "repaired_sha256": state["sha"].hexdigest()}

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if state is None or r["ck"] != key:
                    if state:
                        out.append(done())
                    key = r["ck"]
                    state = {"conv_id": r["conv_id"], "lo": None, "hi": None, "turns": 0, "audit": [], "sha": hashlib.sha256(),
                             "begun": False} | dict.fromkeys(_SUMS, 0)
                for c in _SUMS:
                    state[c] += r[c]
                state["turns"] += r["turns"]
                if r["turn_lo"] is not None:
                    state["lo"] = r["turn_lo"] if state["lo"] is None else state["lo"]
                    state["hi"] = r["turn_hi"]
                state["audit"].append(r["audit"])
                if r["repaired"]:
                    text = "\n".join(f"{t['role']}:{t['text']}" for t in r["repaired"])
                    state["sha"].update((("\n" if state["begun"] else "") + text).encode())
                    state["begun"] = True
            yield pa.RecordBatch.from_pylist(out, schema=schema)
        if state:
            yield pa.RecordBatch.from_pylist([done()], schema=schema)

    return run


def op13_conversation_repair(spark, sf_dir: str) -> DataFrame:
    conv = table(spark, sf_dir, "conversations")
    parts = repair_conversations(damaged(conv), copies="copies")
    parts = parts.withColumn("ck", key_of("ck", F.col("conv_id")))
    out = StructType([StructField("conv_id", conv.schema["conv_id"].dataType),
                      *StructType.fromDDL("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
                                          "cost bigint, audit string, repaired_sha256 string").fields])
    digests = _digests(to_arrow_schema(out))
    # most conversations are one part; the parts of the others are put in order (SHA-256 is sequential)
    whole = parts.filter("single").mapInArrow(digests, out)
    split = parts.filter("NOT single").repartition("ck").sortWithinPartitions("ck", "pid", "seq").mapInArrow(digests, out)
    return whole.unionByName(split)


#: One step of the recursion reads one row: up to two inserts, then delete, keep or rerole; per state the cheapest
#: edits stay, of equal ones the first in ASCII.  CRC-32 is taken bit by bit.
OP13_SQL = r"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(
      coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT)),
      lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) AS c
  FROM conversations),
kinds AS (SELECT *, xor(c, 4294967295) % 20 AS kind FROM raw),
rowed AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM rowed),
faults AS (
  SELECT *, substr(role, 1, 1) AS f,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
      WHEN right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
    lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS prev
  FROM numbered),
counts AS (
  SELECT conv_id, CASE WHEN max(turn) IS NULL THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps,
    count(*) FILTER (WHERE fault = 1) AS blank, count(*) FILTER (WHERE fault = 2) AS duplicate,
    count(*) FILTER (WHERE fault = 3) AS truncated,
    count(*) FILTER (WHERE prev IS NOT NULL AND prev || f NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id),
ins(s, t, cost, audit, said) AS (VALUES
  (0, 0, 0, '', []), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
  (0, 2, 3, 'I', ['user:']), (1, 2, 3, 'I', ['user:']), (2, 3, 3, 'I', ['assistant:']), (3, 2, 3, 'I', ['user:']),
  (0, 3, 6, 'II', ['user:', 'assistant:']), (1, 3, 6, 'II', ['user:', 'assistant:']),
  (2, 2, 6, 'II', ['assistant:', 'user:']), (3, 3, 6, 'II', ['user:', 'assistant:'])),
edits(s, e, f, t) AS (VALUES
  (0, 'D', NULL, 0), (1, 'D', NULL, 1), (2, 'D', NULL, 2), (3, 'D', NULL, 3),
  (0, 'K', 's', 1), (0, 'K', 'u', 2), (1, 'K', 'u', 2), (3, 'K', 'u', 2), (2, 'K', 'a', 3),
  (0, 'R', NULL, 2), (1, 'R', NULL, 2), (3, 'R', NULL, 2), (2, 'R', NULL, 3)),
steps AS (
  SELECT ins.s, edits.t, ins.audit || e AS audit, ins.cost + CASE e WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END AS cost,
    said, e, f, CASE WHEN edits.t = 3 THEN 'assistant:' ELSE 'user:' END AS as_role
  FROM ins JOIN edits ON edits.s = ins.t),
walk AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS s, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS out FROM conversations
  UNION ALL
  SELECT w.conv_id, w.i + 1, p.t, w.cost + p.cost + CASE WHEN r.fault = 3 AND e <> 'D' THEN 3 ELSE 0 END AS cost,
    w.audit || p.audit AS audit,
    list_concat(w.out, p.said, CASE e WHEN 'D' THEN [] WHEN 'K' THEN [r.role || ':' || r.text] ELSE [as_role || r.text] END) AS out
  FROM walk w JOIN faults r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1
    JOIN steps p ON p.s = w.s AND (p.f IS NULL OR p.f = r.f) AND (p.e = 'D' OR r.fault NOT IN (1, 2))
  QUALIFY row_number() OVER (PARTITION BY w.conv_id, p.t
    ORDER BY w.cost + p.cost + CASE WHEN r.fault = 3 AND e <> 'D' THEN 3 ELSE 0 END, w.audit || p.audit) = 1),
ends AS (
  SELECT w.conv_id, w.cost + ins.cost AS cost, w.audit || ins.audit AS audit, list_concat(w.out, said) AS out
  FROM walk w JOIN ins ON ins.s = w.s
  WHERE ((ins.t = 0 AND ins.s = 0) OR ins.t = 3)
    AND NOT EXISTS (SELECT 1 FROM faults r WHERE r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i > w.i)),
best AS (SELECT * FROM ends QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) = 1)
SELECT best.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, cost::BIGINT AS cost, audit,
  sha256(array_to_string(out, chr(10))) AS repaired_sha256
FROM best LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM best.conv_id
"""
