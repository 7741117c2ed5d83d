"""Monotone sequences in Elias-Fano form, searched many keys at a time."""

from __future__ import annotations

import mmap

import numpy as np


class Arena:
    """Byte levels laid one after another in a memory map that belongs to no file."""

    def __init__(self, levels: list[np.ndarray]) -> None:
        self.size = sum(-(-a.nbytes // 8) * 8 for a in levels)
        self.map = mmap.mmap(-1, max(self.size, 8))
        self.views, at = [], 0
        for a in levels:
            view = np.frombuffer(self.map, dtype=a.dtype, count=len(a), offset=at)
            view[:] = a
            self.views.append(view)
            at += -(-a.nbytes // 8) * 8


class EliasFano:
    """A non-decreasing sequence: low bits as they are, high bits in unary.

    ``levels`` are the arrays to be mapped; ``open`` takes them back as views. The
    unary part is read into the starts of its buckets when a level is opened.
    """

    def __init__(self, values: np.ndarray) -> None:
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        self.n, self.shift = n, max(0, (top // max(n, 1)).bit_length() - 1)
        self.buckets = (top >> self.shift) + 1
        values = values.astype(np.uint64)
        high = (values >> np.uint64(self.shift)).astype(np.int64)
        low = values & np.uint64((1 << self.shift) - 1)
        bits = np.zeros(n + self.buckets, dtype=np.uint8)
        bits[high + np.arange(n)] = 1
        self.levels = [np.packbits(bits), (low & np.uint64(0xFFFFFFFF)).astype(np.uint32)]
        if self.shift > 32:
            self.levels.append((low >> np.uint64(32)).astype(np.uint32 if self.shift > 48 else np.uint16))
        self.starts: np.ndarray | None = None

    def open(self, views: list[np.ndarray]) -> None:
        self.levels = views
        zeros = np.flatnonzero(np.unpackbits(views[0], count=self.n + self.buckets) == 0)
        # the zero that ends bucket b stands after all values of buckets up to b
        self.starts = np.concatenate([[0], zeros - np.arange(len(zeros))]).astype(np.int64)

    def _low(self, at: np.ndarray) -> np.ndarray:
        low = self.levels[1][at].astype(np.uint64)
        if len(self.levels) > 2:
            low |= self.levels[2][at].astype(np.uint64) << np.uint64(32)
        return low

    def get(self, at: np.ndarray) -> np.ndarray:
        """Values at given places."""
        high = np.searchsorted(self.starts, at, side="right") - 1
        return (high.astype(np.uint64) << np.uint64(self.shift)) | self._low(at)

    def successor(self, keys: np.ndarray, first: np.ndarray | None = None, stop: np.ndarray | None = None) -> np.ndarray:
        """Place of the first value not below each key, within ``first`` to ``stop``
        if given; ``stop`` if there is none."""
        keys = keys.astype(np.uint64)
        high = np.minimum(keys >> np.uint64(self.shift), np.uint64(self.buckets)).astype(np.int64)
        beyond = high >= self.buckets
        high = np.minimum(high, self.buckets - 1)
        lo, hi = self.starts[high], self.starts[high + 1]
        lo = np.where(beyond, self.n, lo)
        hi = np.where(beyond, self.n, hi)
        if first is not None:
            lo, hi = np.maximum(lo, first), np.maximum(np.minimum(hi, stop), first)
            lo = np.minimum(lo, hi)
        low = keys & np.uint64((1 << self.shift) - 1)
        live = np.flatnonzero(lo < hi)
        while len(live):
            mid = (lo[live] + hi[live]) >> 1
            less = self._low(mid) < low[live]
            lo[live] = np.where(less, mid + 1, lo[live])
            hi[live] = np.where(less, hi[live], mid)
            live = live[lo[live] < hi[live]]
        return lo

    def find(self, keys: np.ndarray, first: np.ndarray | None = None, stop: np.ndarray | None = None) -> np.ndarray:
        """Place of each key, or -1."""
        at = self.successor(keys, first, stop)
        inside = at < (self.n if stop is None else stop)
        place = np.where(inside, at, 0)
        if not self.n:
            return np.full(len(keys), -1, dtype=np.int64)
        # the bucket of a place is that of the key, or the place is the next bucket's first
        high = np.minimum(keys >> np.uint64(self.shift), np.uint64(self.buckets)).astype(np.int64)
        ok = inside & (high < self.buckets)
        ok &= place < self.starts[np.minimum(high, self.buckets - 1) + 1]
        ok &= self._low(place) == (keys & np.uint64((1 << self.shift) - 1))
        return np.where(ok, at, -1)
