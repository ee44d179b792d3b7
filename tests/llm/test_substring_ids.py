"""Substring dedup of repeated and null ids, and of rows repeated many times."""

import random

from strata.llm.common import NULL_ID
from strata.llm.substring_dedup import repeated_keys, substring_dedup


def removed(docs, size=50):
    """Removed words of each row; a null id comes after every other."""
    first = {}
    split = [(NULL_ID if i is None else i, (t or "").split()) for i, t in docs]
    for i, w in split:
        for p in range(len(w) - size + 1):
            k = tuple(w[p:p + size])
            first[k] = min(first.get(k, i), i)
    out = []
    for i, w in split:
        gone = set()
        for p in range(len(w) - size + 1):
            if first[tuple(w[p:p + size])] < i:
                gone.update(range(p, p + size))
        out.append(len(gone))
    return out


def run(spark, docs):
    rows = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(docs)], "doc_id bigint, text string, nth int")
    return [r.n_removed for r in sorted(substring_dedup(rows.repartition(3), carry=("nth",)).collect(), key=lambda r: r.nth)]


def test_texts_of_one_id(spark):
    rnd = random.Random(1)

    def words(n):
        return [f"w{rnd.random()}" for _ in range(n)]

    shared = words(200)
    x, y = words(40) + shared + words(30), words(60) + shared + words(10)
    d = words(20) + shared[70:130] + words(20)
    for i in (9, None):
        docs = [(i, " ".join(x)), (i, " ".join(y)), (3, " ".join(d))]
        assert run(spark, docs) == removed(docs) == [60, 60, 0]


def test_random_documents_with_few_ids(spark):
    rnd = random.Random(2)
    pool = [[f"p{k}x{j}" for j in range(rnd.randint(40, 160))] for k in range(12)]
    docs = []
    for _ in range(80):
        w = []
        for _ in range(rnd.randint(1, 4)):
            p = rnd.choice(pool)
            a = rnd.randint(0, 30)
            w += p[a:a + rnd.randint(20, 150)] + [f"u{rnd.random()}"] * rnd.randint(0, 2)
        docs.append((rnd.choice([1, 2, 3, 4, 5, None, None]), " ".join(w)))
    docs += [docs[0]] * 5 + [docs[1]] * 3
    assert run(spark, docs) == removed(docs)


def test_repeated_rows_are_keyed_once(spark):
    text = " ".join(f"w{k}" for k in range(300))
    docs = [(1, text)] + [(2, text)] * 200
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    rows = repeated_keys(frame, 50, 16, "doc_id", "text").collect()
    assert len(rows) == 1 and len(rows[0].exts) < 30
    assert run(spark, docs) == removed(docs)
