"""Seeded bijections of 0..n-1, one for each replicate, by arithmetic.

A generalised Feistel network on Z_a x Z_c (a * c just over n) with cycle walking: where
replicate b sends a rank depends on (rank, b) alone, so a permutation of a ranked table
needs no copy, sort or shuffle of it.  The same arithmetic runs in numpy inside tasks
and in SQL."""

from __future__ import annotations

import hashlib

import numpy as np

PRIME = 2_147_483_647
HALF = 1 << 29
ROUNDS = 4


def bijection_constants(seed, salt) -> list[tuple[int, ...]]:
    """Per round six constants from md5(seed:salt:round): three that mix the replicate
    into the round's key and three that mix the half."""
    out = []
    for i in range(ROUNDS):
        hexes = "".join(hashlib.md5(f"{seed}:{salt}:{i}:{part}".encode()).hexdigest() for part in (0, 1))
        out.append(tuple(1 + int(hexes[8 * k: 8 * k + 8], 16) % (HALF - 1) for k in range(6)))
    return out


def halves(n: int) -> tuple[int, int]:
    """a, c with a * c >= n, a the least integer whose square is at least n."""
    a = max(1, int(np.sqrt(n)))
    while a * a < n:
        a += 1
    while a > 1 and (a - 1) * (a - 1) >= n:
        a -= 1
    return a, -(-n // a)


def _keys(b: np.ndarray, constants) -> list[np.ndarray]:
    """Per round what a replicate adds to a half."""
    return [((b + t1) * (b + t1) % PRIME * t2 + t3) % PRIME % HALF + s1 for t1, t2, t3, s1, _, _ in constants]


def _mod(x: np.ndarray, d: int) -> np.ndarray:
    """x % d of non-negative integers; division by one number is much faster than the remainder."""
    return x - x // d * d


def _mod_prime(x: np.ndarray) -> np.ndarray:
    """x % PRIME for 0 <= x < 2**62, by folding (PRIME is 2**31 - 1)."""
    x = (x & PRIME) + (x >> 31)
    x = (x & PRIME) + (x >> 31)
    return np.where(x >= PRIME, x - PRIME, x)


def _step(x, keys, constants, a: int, c: int):
    left = x // c
    right = x - left * c
    for i, (key, (*_, s2, s3)) in enumerate(zip(keys, constants, strict=True)):
        mixed = (right if i % 2 == 0 else left) + key
        mixed = _mod_prime(_mod_prime(mixed * mixed) * s2 + s3)
        if i % 2 == 0:
            left = _mod(left + mixed, a)
        else:
            right = _mod(right + mixed, c)
    return left * c + right


TILE = 32_768                        # cells that are worked on together, in the processor's cache


def positions(ranks: np.ndarray, replicates: np.ndarray, n: int, constants) -> np.ndarray:
    """(rows x replicates): where each replicate sends each rank of 0..n-1."""
    a, c = halves(n)
    keys = _keys(replicates.astype(np.int64), constants)          # once per replicate, not per cell
    ranks = ranks.astype(np.int64)[:, None]
    x = np.empty((len(ranks), len(replicates)), np.int64)
    rows = max(1, TILE // max(1, len(replicates)))
    for at in range(0, len(ranks), rows):
        x[at:at + rows] = _step(np.broadcast_to(ranks[at:at + rows], x[at:at + rows].shape), keys, constants, a, c)
    row, of = np.nonzero(x >= n)
    while len(row):                                      # walk the cycle back into the domain
        moved = _step(x[row, of], [k[of] for k in keys], constants, a, c)
        x[row, of] = moved
        out = moved >= n
        row, of = row[out], of[out]
    return x


def position_sql(source: str, constants) -> str:
    """One step of the bijection as SQL: ``source`` (columns x, b, a, c and others) with
    the column y; ranks that are not below n afterwards are walked on in a recursion."""
    sql = f"SELECT *, x // c AS l0, x % c AS r0 FROM ({source})"
    for i, (t1, t2, t3, s1, s2, s3) in enumerate(constants):
        half, into, size = (f"r{i}", f"l{i}", "a") if i % 2 == 0 else (f"l{i}", f"r{i}", "c")
        base = f"({half} + ((b + {t1}) * (b + {t1}) % {PRIME} * {t2} + {t3}) % {PRIME} % {HALF} + {s1})"
        new = f"({into} + ({base} * {base} % {PRIME} * {s2} + {s3}) % {PRIME}) % {size}"
        left, right = (new, f"r{i}") if i % 2 == 0 else (f"l{i}", new)
        sql = f"SELECT * EXCLUDE (l{i}, r{i}), {left} AS l{i + 1}, {right} AS r{i + 1} FROM ({sql})"
    return f"SELECT * EXCLUDE (l{ROUNDS}, r{ROUNDS}), l{ROUNDS} * c + r{ROUNDS} AS y FROM ({sql})"
