"""Plain Python versions of the operator queries: {id: row values}."""

import base64
import hashlib
import re
import zlib
from collections import defaultdict

import xxhash


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def substring_dedup(docs, size=50):
    first = {}
    for i, t in docs:
        w = words(t)
        for p in range(len(w) - size + 1):
            k = tuple(w[p:p + size])
            first[k] = min(first.get(k, i), i)
    out = {}
    for i, t in docs:
        w = words(t)
        gone = set()
        for p in range(len(w) - size + 1):
            if first[tuple(w[p:p + size])] < i:
                gone.update(range(p, p + size))
        out[i] = (len(w), len(gone), sha(" ".join(x for p, x in enumerate(w) if p not in gone)))
    return out


def chat(rows):
    """rows: (conv, turn, role, text)"""
    conv = defaultdict(list)
    for c, n, r, t in rows:
        conv[c].append((n, r or "", t or ""))
    out = {}
    for c, turns in conv.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), sha(loss))
    return out


def simhash(docs, shingle=3, bits=2):
    fp = {}
    for i, t in docs:
        t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = words(t)
        grams = [" ".join(w[p:p + shingle]) for p in range(max(1, len(w) - shingle + 1))] if w else []
        h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        fp[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    distinct = sorted(set(fp.values()))
    root = {x: x for x in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(distinct):
        for b in distinct[:k]:
            if (a ^ b).bit_count() <= bits:
                root[find(a)] = find(b)
    least = {}
    for i, x in fp.items():
        least[find(x)] = min(least.get(find(x), i), i)
    return {i: (f"{x:016x}", least[find(x)]) for i, x in fp.items()}


def edited(docs):
    docs = sorted((i, t or "") for i, t in docs)
    out = {}
    for k, (i, t) in enumerate(docs):
        half = len(t) // 2
        out[i] = (len(t), sha(t[:len(t) - half] + docs[(k + 1) % len(docs)][1][:half]))
    return out


def warc(pages):
    last = {}
    for i, t in pages:
        last[t or ""] = max(last.get(t or "", i), i)
    out = {}
    for i, t in pages:
        b = (t or "").encode()
        own = last[t or ""] == i
        out[i] = (len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if own else "revisit",
                  None if own else last[t or ""])
    return out


def sentencepiece(docs, path):
    import sentencepiece as sp
    m = sp.SentencePieceProcessor(model_file=path)
    out = {}
    for i, t in docs:
        ids = m.encode(t or "")
        out[i] = (len(ids), sha(",".join(map(str, ids))), sha(m.decode(ids)))
    return out


def crc(text):
    return zlib.crc32((text or "").encode())


def token_count(text, scores, fallback, floor, space="▁"):
    """(tokens, unknown, score) by dynamic programming over all substrings."""
    if not text:
        return 0, 0, 0.0
    s = space + text.replace(" ", space)
    longest = max(map(len, scores))
    best = [(0.0, 0, 0)] + [None] * len(s)
    for end in range(1, len(s) + 1):
        got = None
        single = False
        for start in range(max(0, end - longest), end):
            p = scores.get(s[start:end])
            if p is not None:
                single = single or end - start == 1
                b = best[start]
                if got is None or b[0] + p > got[0]:
                    got = (b[0] + p, b[1] + 1, b[2])
        if not single:
            b = best[end - 1]
            if got is None or b[0] + floor > got[0]:
                got = (b[0] + floor, b[1] + (len(s[end - 1].encode()) if fallback else 1), b[2] + 1)
        best[end] = got
    score, n, unknown = best[-1]
    return n, unknown, score
