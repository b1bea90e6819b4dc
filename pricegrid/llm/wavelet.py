"""A wavelet matrix over token ids.

One bit-plane per bit of the largest id, highest bit first: after each plane the
ids with a 0 come before those with a 1, both in their order. A directory of ones
before each 512-bit block makes rank one lookup and a count in one block, so a
token is read, counted up to a place, or found by its k-th occurrence with one or
two steps a plane.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BLOCK = 64  # bytes of a plane for each entry of its directory
_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)


@dataclass
class WaveletMatrix:
    n: int
    zeros: list[int]  # ids with a 0, by plane
    planes: list[np.ndarray]  # packed bits
    ranks: list[np.ndarray]  # ones before each block

    @classmethod
    def build(cls, ids: np.ndarray, width: int) -> WaveletMatrix:
        zeros, planes, ranks = [], [], []
        ids = ids.astype(np.uint16 if width <= 16 else np.uint32)
        for bit in range(width - 1, -1, -1):
            one = (ids & ids.dtype.type(1 << bit)).astype(bool)
            plane = np.packbits(one)
            planes.append(plane)
            ranks.append(cls._directory(plane))
            ones = ids[one]
            zeros.append(len(ids) - len(ones))
            if bit:
                ids = np.concatenate([ids[np.logical_not(one, out=one)], ones])
        return cls(len(ids), zeros, planes, ranks)

    @staticmethod
    def _directory(plane: np.ndarray) -> np.ndarray:
        padded = np.zeros(-(-len(plane) // BLOCK) * BLOCK, np.uint8)
        padded[: len(plane)] = _ONES[plane]
        out = np.zeros(len(padded) // BLOCK + 1, np.int64)
        np.cumsum(padded.reshape(-1, BLOCK).sum(1, dtype=np.int64), out=out[1:])
        return out

    @property
    def width(self) -> int:
        return len(self.planes)

    def _rank1(self, plane: int, i: int) -> int:
        """Ones among the first i bits."""
        block, inside = divmod(i, BLOCK * 8)
        bits = np.unpackbits(self.planes[plane][block * BLOCK : block * BLOCK + -(-inside // 8)])[:inside]
        return int(self.ranks[plane][block]) + int(bits.sum())

    def _select(self, plane: int, k: int, bit: int) -> int:
        """Place of the k-th (from 0) such bit."""
        ones = self.ranks[plane]
        before = ones if bit else np.arange(len(ones)) * BLOCK * 8 - ones
        block = int(np.searchsorted(before, k, "right")) - 1
        block = min(block, len(ones) - 2)
        bits = np.unpackbits(self.planes[plane][block * BLOCK : (block + 1) * BLOCK])
        return block * BLOCK * 8 + int(np.flatnonzero(bits == bit)[k - int(before[block])])

    def access(self, i: int) -> int:
        token = 0
        for plane in range(self.width):
            bit = int(self.planes[plane][i >> 3] >> (7 - (i & 7))) & 1
            token = token * 2 + bit
            ones = self._rank1(plane, i)
            i = self.zeros[plane] + ones if bit else i - ones
        return token

    def _range(self, token: int, i: int) -> tuple[int, int]:
        start, end = 0, i
        for plane in range(self.width):
            one = token >> (self.width - 1 - plane) & 1
            a, b = self._rank1(plane, start), self._rank1(plane, end)
            start, end = (self.zeros[plane] + a, self.zeros[plane] + b) if one else (start - a, end - b)
        return start, end

    def rank(self, token: int, i: int) -> int:
        """Occurrences among the first i ids."""
        if token < 0 or token >> self.width:
            return 0
        start, end = self._range(token, i)
        return end - start

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        at = self._range(token, self.n)[0] + k
        for plane in range(self.width - 1, -1, -1):
            one = token >> (self.width - 1 - plane) & 1
            at = self._select(plane, at - self.zeros[plane] if one else at, one)
        return at

    def decode(self) -> np.ndarray:
        """All ids in order."""
        ids = np.zeros(self.n, np.uint16 if self.width <= 16 else np.uint32)
        for plane in range(self.width - 1, -1, -1):
            one = np.unpackbits(self.planes[plane], count=self.n).view(bool)
            out = np.empty_like(ids)
            out[one] = ids[self.zeros[plane] :] | ids.dtype.type(1 << (self.width - 1 - plane))
            out[np.logical_not(one)] = ids[: self.zeros[plane]]
            ids = out
        return ids
