"""Words of whole Arrow text columns as arrays of positions and hashes.

A word is a run of characters other than space and tab, line feed, vertical tab,
form feed, carriage return. Work is done on the UTF-8 bytes of many texts at once;
no Python object is made for a word. A null text counts as empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_BLOCK = 1 << 20
_PRIME = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every input bit over all output bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=U64)


BYTE = mix(np.arange(1, 257, dtype=U64))
_low = np.arange(256)
_low[65:91] += 32
BYTE_LOWER = BYTE[_low]
_up, _down = _powers(_PRIME, _BLOCK), _powers(pow(_PRIME, -1, 1 << 64), _BLOCK)


class Texts:
    """The bytes of a text column; text ``i`` is ``data[start[i]:end[i]]``."""

    def __init__(self, column: pa.Array):
        column = pc.fill_null(column.cast(pa.large_string()), "")
        _, offsets, data = column.buffers()
        at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        raw = np.frombuffer(data, np.uint8) if data is not None and len(column) else np.zeros(0, np.uint8)
        self.n = len(column)
        lo, hi = (int(at[0]), int(at[-1])) if self.n else (0, 0)
        self.data = raw[lo:hi]
        self.start, self.end = at[:-1] - lo, at[1:] - lo

    def runs(self, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of bytes of one non-zero ``kind`` within a text: start, end, and where each text's runs begin."""
        k, n = kind[self.data], len(self.data)
        change = np.empty(n + 1, bool)
        change[0] = change[n] = True
        np.not_equal(k[1:], k[:-1], out=change[1:n])
        change[self.start] = True  # a text's end is the next one's start
        cut = np.flatnonzero(change)
        s, e = cut[:-1], cut[1:]
        if n:
            held = k[s] != 0
            s, e = s[held], e[held]
        return s, e, np.append(np.searchsorted(s, self.start), len(s))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.runs((~IS_SPACE).astype(np.uint8))

    def hashes(self, s: np.ndarray, e: np.ndarray, table: np.ndarray = BYTE) -> np.ndarray:
        """64-bit hashes of the byte ranges, which ascend and don't overlap."""
        out = np.zeros(len(s), U64)
        i = 0
        with np.errstate(over="ignore"):
            while i < len(s):
                lo = s[i]
                j = max(i + 1, int(np.searchsorted(e, lo + _BLOCK, "right")))
                n = int(e[j - 1] - lo)
                up, down = (_up, _down) if n <= _BLOCK else (_powers(_PRIME, n), _powers(pow(_PRIME, -1, 1 << 64), n))
                total = np.zeros(n + 1, U64)
                np.cumsum(table[self.data[lo : lo + n]] * up[:n], out=total[1:])
                a, b = s[i:j] - lo, e[i:j] - lo
                out[i:j] = (total[b] - total[a]) * down[np.minimum(a, n - 1)]
                i = j
            return mix(out + (e - s).astype(U64) * U64(_PRIME))


def owners(first: np.ndarray) -> np.ndarray:
    """The text of each run, from where each text's runs begin."""
    return np.repeat(np.arange(len(first) - 1, dtype=np.int64), np.diff(first))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of ``k`` neighbours; entry ``i`` starts at ``i`` (texts may meet inside: see ``within``)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    with np.errstate(over="ignore"):
        out = h[:n].copy()
        for j in range(1, k):
            out *= U64(_PRIME)
            out += h[j : j + n]
        return mix(out)


def within(doc: np.ndarray, k: int) -> np.ndarray:
    """Which groups of ``k`` neighbours lie in one text."""
    n = len(doc) - k + 1
    return doc[:n] == doc[k - 1 :] if n > 0 else np.zeros(0, bool)


def shingles(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``k`` words of each text, sorted: (hash, where each text's begin).

    A text of fewer words, but at least one, has one shingle: all its words.
    """
    doc = owners(first)
    keep = within(doc, k)
    g, d = grams(h, k)[keep], doc[: len(keep)][keep]
    counts = np.diff(first)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        extra = np.array([mix(np.array([_fold(h[first[i] : first[i + 1]])], U64))[0] for i in short], U64)
        g, d = np.append(g, extra), np.append(d, short)
    order = np.lexsort((g, d))
    g, d = g[order], d[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (d[1:] != d[:-1])
    g, d = g[new], d[new]
    return g, np.searchsorted(d, np.arange(len(first)))


def _fold(h: np.ndarray) -> int:
    out = len(h)
    for x in h.tolist():
        out = (out * _PRIME + x) % (1 << 64)
    return out
