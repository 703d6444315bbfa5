"""Vectorised words, word hashes and word windows over batches of UTF-8 texts.

Every function works on numpy arrays inside one Spark task, on batches that
``batches`` bounds in bytes. A text is never cut: one longer than the bound
makes a batch of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

U64 = np.uint64
NONE = U64(0xFFFFFFFFFFFFFFFF)
# odd multipliers of the two polynomial hashes (bytes of a word, words of a window)
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
BATCH_BYTES = 1 << 20
_BLOCK = 1 << 15  # words hashed at a time: their arrays fit a core's cache


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    """Byte class: true for the bytes in any of the closed ``ranges``."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low:high + 1] = True
    return table


#: complements of the word classes ``[^\\x20\\x09-\\x0D]+`` and
#: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` (the second on lower-cased text)
SPACES = separators((0x20, 0x20), (0x09, 0x0D))
NON_WORDS = separators((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 18)
            with np.errstate(over="ignore"):
                for name, factor in (("up", self.base), ("down", self.inverse)):
                    steps = np.full(size, factor, U64)
                    steps[0] = 1
                    setattr(self, name, np.cumprod(steps))
        return self.up, self.down


_bytes, _words = _Powers(_BYTE_BASE), _Powers(_WORD_BASE)


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                 powers: _Powers) -> np.ndarray:
    """Polynomial hash of ``values[s:e]`` for each (s, e), whatever its place."""
    up, down = powers.upto(len(values) + 1)
    sums = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[:len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


@dataclass
class Words:
    """The words of a batch: ``buf[starts[i]:ends[i]]`` is word i with 64-bit hash
    ``hashes[i]``; document d has words ``first[d]`` to ``first[d + 1]``."""

    buf: bytes
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words from each word on, and whether they are all in
        the word's document (else the hash is ``NONE``)."""
        n = len(self.starts)
        out, ok = np.full(n, NONE, U64), np.zeros(n, bool)
        if n >= k:
            at = np.arange(n - k + 1)
            last = np.repeat(self.first[1:], np.diff(self.first))[:len(at)]
            ok[:len(at)] = at + k <= last
            for a in range(0, len(at), _BLOCK):
                b = min(a + _BLOCK, len(at))
                i = np.arange(b - a)
                out[a:b] = range_hashes(self.hashes[a:b + k - 1], i, i + k, _words)
            out[~ok] = NONE
            np.minimum(out, NONE - U64(1), out=out, where=ok)
        return out, ok

    def text(self, a: int, b: int) -> bytes:
        """Words a to b (b excluded) joined by one space."""
        return b" ".join([self.buf[s:e] for s, e in zip(self.starts[a:b].tolist(),
                                                         self.ends[a:b].tolist())])


def split_words(texts: list[bytes | None], seps: np.ndarray, lower: bool = False) -> Words:
    """Words of each text (null: none); ``lower`` lower-cases A-Z first."""
    joined = b"\n".join([t or b"" for t in texts])
    if lower:
        joined = joined.lower()
    raw = np.frombuffer(joined, np.uint8)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~seps[raw]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    hashes = np.empty(len(starts), U64)
    for a in range(0, len(starts), _BLOCK):
        b = min(a + _BLOCK, len(starts))
        s0, e0 = starts[a], ends[b - 1]
        hashes[a:b] = range_hashes(raw[s0:e0].astype(U64) + U64(1), starts[a:b] - s0,
                                   ends[a:b] - s0, _bytes)
    bounds = np.cumsum([0] + [len(t or b"") + 1 for t in texts])
    return Words(joined, starts, ends, hashes, np.searchsorted(starts, bounds))


def sliding(values: np.ndarray, w: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` (minimum or maximum) over ``values[i:i + w]`` for each i with a
    whole window; empty when there is none."""
    if len(values) < w:
        return values[:0]
    out, width = values, 1
    while width < w:
        step = min(width, w - width)
        out = pick(out[:len(out) - step], out[step:])
        width += step
    return out


def batches(rows: Iterable, size, limit: int = BATCH_BYTES) -> Iterator[list]:
    """Consecutive rows in lists of at most ``limit`` bytes by ``size(row)``."""
    out, total = [], 0
    for row in rows:
        n = size(row)
        if out and total + n > limit:
            yield out
            out, total = [], 0
        out.append(row)
        total += n
    if out:
        yield out
