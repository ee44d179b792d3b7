"""Conversation repair against dynamic programming over the damaged rows."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

from strata.llm.conversation_repair import START, STATES, Search, repair_conversations
from strata.llm.repair_query import op13_conversation_repair

NEED = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
FITS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}


def repaired(rows):
    """rows: (turn, role, text) of one conversation after damage."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        faults.append(1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0)
        seen.add((role, text))
    best = {0: (0, "", ())}
    for (_, role, text), fault in zip(rows, faults, strict=True):
        new = {}
        for s, (cost, audit, out) in best.items():
            for n in range(3):
                u, c, a, o = s, cost, audit, out
                for _ in range(n):
                    o, c, a, u = (*o, (NEED[u][0], "")), c + 3, a + "I", NEED[u][1]
                ways = [(c + 4, a + "D", o, u)]
                if fault not in (1, 2):
                    stay = 3 * (fault == 3)
                    if (u, role[:1]) in FITS:
                        ways.append((c + stay, a + "K", (*o, (role, text)), FITS[u, role[:1]]))
                    ways.append((c + 3 + stay, a + "R", (*o, (NEED[u][0], text)), NEED[u][1]))
                for cc, aa, oo, t in ways:
                    if t not in new or (cc, aa) < new[t][:2]:
                        new[t] = (cc, aa, oo)
        best = new
    ends = []
    for s, (cost, audit, out) in best.items():
        while s not in (0, 3):
            out, cost, audit, s = (*out, (NEED[s][0], "")), cost + 3, audit + "I", NEED[s][1]
        ends.append((cost, audit, out))
    cost, audit, out = min(ends)
    known = {r[0] for r in rows if r[0] is not None}
    firsts = [r[1][:1] for r in rows]
    return (max(known) - min(known) + 1 - len(known) if known else 0, faults.count(1), faults.count(2), faults.count(3),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:], strict=False)), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


def brute(rows):
    conv = defaultdict(list)
    for c, turn, role, text in rows:
        one = conv[c]
        key = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        one += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {c: repaired(r) for c, r in conv.items()}


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def run(spark, path):
    rows = op13_conversation_repair(spark, path).collect()
    out = {r.conv_id: tuple(r[n] for n in NAMES) for r in rows}
    assert len(out) == len(rows)
    return out


def test_whole_table(spark, tables):
    c = tables("conversations")
    rows = [tuple(None if x != x else x for x in r) for r in c[["conv_id", "turn", "role", "text"]].itertuples(index=False)]
    assert run(spark, tables.path) == brute(rows)


def test_odd_conversations(spark, tmp_path):
    """Nulls, repeats, ties, unknown and empty roles, conversations over many blocks and partitions."""
    rnd = random.Random(7)
    texts = ["Yes.", "no", "", " \t", "Why?", "a\nb!", None, "x. ", "é…"]
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    rows = []
    for c in range(120):
        turn = 0
        for _ in range(rnd.randint(1, 12)):
            turn += rnd.choice([0, 1, 1, 1, 3])
            rows.append((c, rnd.choice([turn, turn, turn, None]), rnd.choice(roles), rnd.choice([*texts, f"t{rnd.random()}."])))
    for n in range(900):                                 # two long conversations, one of them the null id
        for c in (500, None):
            rows.append((c, n, rnd.choice(["user", "assistant"]), rnd.choice([*texts, *[f"t{rnd.random()}."] * 6])))
    rows += [(501, 1, "user", "again and again.")] * 300 + [(502, None, "user", "q?")] * 40
    rnd.shuffle(rows)
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got, want = run(spark, str(tmp_path)), brute(rows)
    assert got.keys() == want.keys()
    for c in want:
        assert got[c] == want[c], c


def test_searches_of_a_block_agree_with_every_pair(spark):
    """Block searches for each pair of states, chained, cost what the whole search costs."""
    rnd = random.Random(3)
    for _ in range(200):
        units = [(rnd.choice("suat"), rnd.choice([0, 0, 0, 1, 2, 3]), rnd.choice([1, 1, 1, 2])) for _ in range(rnd.randint(2, 9))]
        k = rnd.randint(1, len(units) - 1)
        whole = Search(units, None).best(START)
        front = [Search(units[:k], t).best(START) for t in STATES]
        back = Search(units[k:], None)
        ways = [(f[0] + b[0], f[1] + b[1]) for f, t in zip(front, STATES, strict=True) if f and (b := back.best(t))]
        assert min(ways) == whole


def test_clashing_columns_and_empty_table(spark):
    schema = "conv_id string, turn int, role string, text string, ck string, h string, n int, pid int"
    none = spark.createDataFrame([], schema)
    assert repair_conversations(none).count() == 0
    one = spark.createDataFrame([("a", 1, "user", "Hi.", "x", "y", 5, 6), ("a", 2, "assistant", "Ho.", "x", "y", 5, 6)], schema)
    assert {(r.conv_id, r.cost) for r in repair_conversations(one).groupBy("conv_id").sum("cost").toDF("conv_id", "cost").collect()} == {("a", 0)}


def test_no_rows_cost_nothing():
    assert Search([], None).best(START) == (0, "")
    assert Search([("u", 0, 1), ("a", 0, 1)], None).best(START) == (0, "KK")
