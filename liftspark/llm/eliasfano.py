"""Monotone integer sequences in little space, readable where they lie in a buffer.

A value's low bytes are stored as they are; its high part is coded in unary, in a bit vector shared by all
values. Any value can be read, and the first value not below a bound be found, without decoding the rest.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64


class EliasFano:
    """Non-decreasing unsigned 64-bit values over a buffer made by ``encode``; the buffer may be memory-mapped."""

    def __init__(self, buffer: memoryview | bytes):
        head = np.frombuffer(buffer, np.int64, 4)
        self.n, self.low_bytes, high_bytes, self.size = (int(x) for x in head)
        at = 32 + self.n * self.low_bytes
        self.low = np.frombuffer(buffer, np.uint8, self.n * self.low_bytes, 32).reshape(self.n, self.low_bytes)
        self.high = np.frombuffer(buffer, np.uint8, high_bytes, at)
        self._ones: np.ndarray | None = None
        self._starts: np.ndarray | None = None

    @staticmethod
    def encode(values: np.ndarray) -> bytes:
        values = np.ascontiguousarray(values, dtype="<u8")
        n, top = len(values), int(values[-1]) if len(values) else 0
        low = min(range(8), key=lambda b: 8 * b * n + n + (top >> 8 * b))
        high = (values >> U64(8 * low)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(high[-1]) + 1 if n else 0, bool)
        bits[high] = True
        packed = np.packbits(bits, bitorder="little")
        lows = values.view(np.uint8).reshape(n, 8)[:, :low]
        size = 32 + n * low + len(packed)
        return np.array([n, low, len(packed), size], np.int64).tobytes() + lows.tobytes() + packed.tobytes()

    def _select(self) -> np.ndarray:
        if self._ones is None:
            self._ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little")).astype(np.int64)
        return self._ones

    def _bucket_starts(self) -> np.ndarray:
        """Where values of each high part begin."""
        if self._starts is None:
            parts = self._select() - np.arange(self.n)
            self._starts = np.searchsorted(parts, np.arange((int(parts[-1]) if self.n else -1) + 3))
        return self._starts

    def _lows(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros((len(i), 8), np.uint8)
        out[:, : self.low_bytes] = self.low[i]
        return out.view("<u8").ravel()

    def get(self, i: np.ndarray) -> np.ndarray:
        return ((self._select()[i] - i).astype(U64) << U64(8 * self.low_bytes)) | self._lows(i)

    def values(self) -> np.ndarray:
        return self.get(np.arange(self.n))

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Index of the first value not below each ``x`` (``n`` if there is none)."""
        starts = self._bucket_starts()
        part = np.minimum(x >> U64(8 * self.low_bytes), U64(len(starts) - 2)).astype(np.int64)
        first, last = starts[part], starts[part + 1]
        rest = x & U64((1 << 8 * self.low_bytes) - 1)
        while True:  # binary search within the bucket of the same high part
            open_ = np.flatnonzero(first < last)
            if not len(open_):
                return first
            mid = (first[open_] + last[open_]) // 2
            below = self._lows(mid) < rest[open_]
            first[open_] = np.where(below, mid + 1, first[open_])
            last[open_] = np.where(below, last[open_], mid)


def joined(parts: list[bytes]) -> bytes:
    """Buffers one after the other, each on a multiple of 8 bytes, after their lengths."""
    out = [np.array([len(parts), *map(len, parts)], np.int64).tobytes()]
    for p in parts:
        out.append(p + bytes(-len(p) % 8))
    return b"".join(out)


def parted(buffer: bytes | memoryview) -> list[memoryview]:
    """The buffers that ``joined`` put together, in place."""
    view = memoryview(buffer)
    n = int(np.frombuffer(view, np.int64, 1)[0])
    lengths = np.frombuffer(view, np.int64, n, 8).tolist()
    out, at = [], 8 * (n + 1)
    for length in lengths:
        out.append(view[at : at + length])
        at += length + -length % 8
    return out
