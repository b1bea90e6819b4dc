"""Whole texts of an Arrow batch as one byte buffer, for numpy inside tasks.

Words are runs of bytes other than 0x20 and 0x09-0x0D; A-Z count as a-z where a
caller asks for it. Hashes are 64-bit polynomials over a fixed random table,
mixed at the end, so they are the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20  # bytes hashed at a time; longer words make longer blocks
_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTE_VALUE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and the n + 1 bounds of the texts; a null
    text has no bytes."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, np.int64 if wide else np.int32)[
        column.offset : column.offset + len(column) + 1
    ].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def need(self, n: int) -> None:
        if len(self.up) >= n:
            return
        self.up = np.full(n, np.uint64(_BASE))
        self.down = np.full(n, np.uint64(_INVERSE))
        self.up[0] = self.down[0] = 1
        np.multiply.accumulate(self.up, out=self.up)
        np.multiply.accumulate(self.down, out=self.down)


def prefix_hash(data: np.ndarray, powers: Powers) -> np.ndarray:
    """n + 1 prefix sums; a substring's polynomial is
    ``(prefix[end] - prefix[start]) * powers.down[start]``."""
    powers.need(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * powers.up[: len(data)], out=out[1:])
    return out


def _blocks(separator: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about BLOCK bytes cut at text bounds, or at separators inside."""
    start, total = 0, int(bounds[-1])
    while start < total:
        end = start + BLOCK
        if end >= total:
            yield start, total
            return
        at = int(np.searchsorted(bounds, end, "right")) - 1
        if bounds[at] > start:
            end = int(bounds[at])
        else:  # inside one text
            stop = int(bounds[at + 1])
            found = separator[end:stop].argmax() if separator[end:stop].any() else stop - end
            end += int(found)
        yield start, end
        start = end


def word_hashes(data: np.ndarray, bounds: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and n + 1 bounds into them by text."""
    separator = SEPARATOR[data]
    first = np.zeros(len(data) + 1, bool)
    first[bounds] = True  # a word may start here although no separator precedes
    hashes, counts = [], np.zeros(len(bounds), np.int64)
    for start, end in _blocks(separator, bounds):
        word = ~separator[start:end]
        before = np.empty(len(word), bool)
        before[0], before[1:] = True, separator[start : end - 1]
        begins = np.flatnonzero(word & (before | first[start:end]))
        after = np.empty(len(word), bool)
        after[-1], after[:-1] = True, separator[start + 1 : end]
        ends = np.flatnonzero(word & (after | first[start + 1 : end + 1])) + 1
        prefix = prefix_hash(data[start:end], powers)
        hashes.append(mixed((prefix[ends] - prefix[begins]) * powers.down[begins] + (ends - begins).astype(np.uint64)))
        text = np.searchsorted(bounds, begins + start, "right") - 1
        counts[1:] += np.bincount(text, minlength=len(bounds) - 1)
    return np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), np.cumsum(counts)
