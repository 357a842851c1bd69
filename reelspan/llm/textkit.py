"""Vectorised text kernels: words, shingles, windows and their 64-bit hashes.

A word is a run of bytes other than 0x20 and 0x09-0x0D. All hashes depend on
the words only, never on position, so equal sequences have equal hashes in
every task. Texts are handled whole, many to a numpy chunk.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_BYTES = np.random.Generator(np.random.PCG64(0x5EED)).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers = {"up": np.ones(1, U64), "down": np.ones(1, U64)}
#: ASCII letters to lower case, other bytes unchanged.
LOWER = bytes(range(256)).translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**64."""
    if len(_powers["up"]) < n:
        size = max(1 << 20, 1 << (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            a = np.full(size, base, U64)
            a[0] = 1
            _powers[name] = np.cumprod(a)
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


@dataclass
class Words:
    """The words of a chunk of texts: byte span, hash, and each text's first word."""

    buffer: bytes
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # one more entry than there are texts

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words(texts: list[bytes]) -> Words:
    """Words of several texts at once; texts are kept apart by a line feed."""
    buffer = b"\n".join(texts) + b"\n"
    a = np.frombuffer(buffer, np.uint8)
    inside = np.empty(len(a) + 1, bool)
    inside[0] = False
    np.logical_not(_SPACE[a], out=inside[1:])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[0::2], edges[1::2]
    up, down = powers(len(a) + 1)
    sums = np.empty(len(a) + 1, U64)
    sums[0] = 0
    terms = _BYTES[a]
    terms *= up[: len(a)]
    np.cumsum(terms, out=sums[1:])
    hashed = mix((sums[end] - sums[start]) * down[start] + (end - start).astype(U64))
    places = np.cumsum([0] + [len(t) + 1 for t in texts])
    return Words(buffer, start, end, hashed, np.searchsorted(start, places))


def sequences(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of every run of k consecutive words; runs may cross texts."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, U64)
    out = np.zeros(n, U64)
    for j in range(k):
        out *= U64(_BASE)
        out += hashes[j : j + n]
    return mix(out)


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each text, and each text's first entry.

    A text of fewer than k words has its whole sequence as one shingle; one
    without words has none.
    """
    counts = w.counts()
    each = np.where(counts >= k, counts - k + 1, (counts > 0).astype(counts.dtype))
    first = np.concatenate(([0], np.cumsum(each)))
    out = np.empty(first[-1], U64)
    if first[-1] == 0:
        return out, first
    runs = sequences(w.hash, k)
    within = np.arange(first[-1]) - np.repeat(first[:-1], each)
    place = np.repeat(w.first[:-1], each) + within
    long = np.repeat(counts >= k, each)
    out[long] = runs[place[long]]
    for t in np.flatnonzero((counts > 0) & (counts < k)):
        whole = sequences(w.hash[w.first[t] : w.first[t + 1]], int(counts[t]))
        out[first[t]] = mix(whole + U64(counts[t]))[0]
    return out, first


def chunks(values: Iterable, size_of, limit: int = 1 << 20) -> Iterator[list]:
    """Consecutive values in lists of about ``limit`` bytes; a longer one is alone."""
    held: list = []
    total = 0
    for v in values:
        n = size_of(v)
        if held and total + n > limit:
            yield held
            held, total = [], 0
        held.append(v)
        total += n
    if held:
        yield held


def universal(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and offsets of ``count`` multiply-add hash functions."""
    g = np.random.Generator(np.random.PCG64(seed))
    return g.integers(0, 1 << 63, count, dtype=np.uint64) * U64(2) + U64(1), g.integers(0, 1 << 63, count, dtype=np.uint64)


def minhash(values: np.ndarray, first: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Signatures, a row for each text: the least of each function over its values.

    Rows of texts without values hold the largest value.
    """
    out = np.full((len(first) - 1, len(a)), np.iinfo(np.uint64).max, U64)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        at = first[:-1][some]
        work = np.empty_like(values)
        for i in range(len(a)):
            np.multiply(values, a[i], out=work)
            work += b[i]
            # the high bits of a product depend on all bits of the value
            out[some, i] = np.minimum.reduceat(work, at)
    return out
