"""Word shingle sets of whole texts, vectorised over the bytes of a batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
_RANDOM = np.random.default_rng(20_11)
#: Random weights of bytes, and an odd base and its inverse modulo 2 ** 64.
BYTE_WEIGHT = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) | U(1)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Bytes that part words, and A-Z as a-z.
IS_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
WORD_WEIGHT = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) | U(1)
#: Bytes of text that are hashed at a time.
BATCH_BYTES = 1_000_000


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(raw: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of a buffer, and where it starts; parts: flags of the bytes between words."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    edge = np.diff(np.concatenate([[True], parts, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_WEIGHT[raw] * _powers(BASE, n), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _powers(INVERSE, n)[starts] + (ends - starts).astype(np.uint64)), starts


def shingle_sets(batch: list[str], k: int = 5) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text's number, sizes of the texts' sets, the sets one after another, each sorted) for runs of texts.

    A set holds the distinct k-word shingles; with fewer words, the whole sequence as one; without words, nothing.
    """
    encoded = [t.encode() for t in batch]
    i = 0
    while i < len(encoded):
        j, size = i, 0
        while j < len(encoded) and (j == i or size + len(encoded[j]) < BATCH_BYTES):
            size += len(encoded[j]) + 1
            j += 1
        raw = LOWER[np.frombuffer(b" ".join(encoded[i:j]) + b" ", np.uint8)]
        hashes, starts = word_hashes(raw, IS_SPACE[raw])
        sizes = np.fromiter(map(len, encoded[i:j]), np.int64, j - i) + 1
        doc = np.searchsorted(np.cumsum(sizes), starts, side="right")
        words = np.bincount(doc, minlength=j - i)
        own, where = [], []
        if len(hashes) >= k:
            rolled = sum((hashes[s : len(hashes) - k + 1 + s] * WORD_WEIGHT[s] for s in range(1, k)), hashes[: len(hashes) - k + 1] * WORD_WEIGHT[0])
            inside = doc[: len(rolled)] == doc[k - 1 :]
            own, where = [mix(rolled[inside])], [doc[: len(rolled)][inside]]
        for d in np.flatnonzero((words > 0) & (words < k)):
            whole = hashes[doc == d]
            own.append(mix((whole * WORD_WEIGHT[: len(whole)]).sum(keepdims=True, dtype=np.uint64) + U(len(whole))))
            where.append(np.array([d]))
        flat, at = (np.concatenate(own), np.concatenate(where)) if own else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        order = np.lexsort((flat, at))
        flat, at = flat[order], at[order]
        first = np.ones(len(flat), bool)
        first[1:] = (flat[1:] != flat[:-1]) | (at[1:] != at[:-1])
        yield i, np.bincount(at[first], minlength=j - i), flat[first]
        i = j
