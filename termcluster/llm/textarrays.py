"""Texts of an Arrow batch as flat numpy arrays: bytes, words, hashes.

A batch is cut into slices of whole texts (``SLICE_BYTES`` of text, or one
text if that is longer), so the arrays of a task stay small whatever the
batch size. All hashes are 64-bit polynomial hashes over a fixed odd base,
finished by a mixing step, and depend only on the content: equal in every
task, on every machine and for every partitioning."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
U = np.uint64

# Odd bases (so that they have an inverse modulo 2**64) of the hashes.
BASE_BYTES = 0x9E3779B97F4A7C15
BASE_ONE = 0xD1342543DE82EF95
BASE_TWO = 0xAF251AF3B0F025B5


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser: spreads every input bit over the word."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    return x


BYTE_VALUES = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))


class Powers:
    """Growing tables of base**i and base**-i modulo 2**64."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << max(16, (n - 1).bit_length())
            self.up, self.down = (np.concatenate(([U(1)], np.cumprod(np.full(size - 1, b, U)))) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


_POWERS = {b: Powers(b) for b in (BASE_BYTES, BASE_ONE, BASE_TWO)}


def prefix_sums(values: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(values) + 1, U)
    np.cumsum(values * _POWERS[base].get(len(values))[0], out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Unmixed polynomial hash of values[start:end], wherever it lies."""
    return (sums[end] - sums[start]) * _POWERS[base].get(len(sums))[1][start]


@dataclass
class Texts:
    """Whole texts in one byte array; text i is data[offsets[i]:offsets[i+1]]."""

    data: np.ndarray
    offsets: np.ndarray
    first: int  # row of text 0 in the batch

    def __len__(self) -> int:
        return len(self.offsets) - 1


def text_slices(column: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[Texts]:
    """Slices of a string column (null: empty text), in order."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    _, off, buf = column.buffers()
    offsets = np.frombuffer(off, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        last = int(np.searchsorted(offsets, offsets[row] + slice_bytes, "right")) - 1
        last = min(max(last, row + 1), n)
        yield Texts(data[offsets[row]:offsets[last]], offsets[row:last + 1] - offsets[row], row)
        row = last


def byte_class(pattern_excludes: str) -> np.ndarray:
    """256 flags: bytes that are not among the excluded ones (all < 0x80)."""
    flags = np.ones(256, bool)
    flags[[ord(c) for c in pattern_excludes]] = False
    return flags


# Words [^\x20\x09-\x0D]+ ; UTF-8 bytes of other characters are all word bytes.
PLAIN_WORD = byte_class("\x20\x09\x0a\x0b\x0c\x0d")
# Words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text.
LETTER_WORD = byte_class("".join(map(chr, [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@dataclass
class Words:
    """Words of several texts in one sequence; those of text i are
    bounds[i]:bounds[i+1]."""

    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray
    hash: np.ndarray


def words(texts: Texts, word_bytes: np.ndarray, lower: bool = False) -> Words:
    data = LOWER[texts.data] if lower else texts.data
    inside = word_bytes[data]
    n = len(data)
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edge = texts.offsets[(texts.offsets > 0) & (texts.offsets < n)]
    before[edge], after[edge - 1] = False, False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    sums = prefix_sums(BYTE_VALUES[data], BASE_BYTES)
    h = mix(range_hash(sums, start, end, BASE_BYTES) + (end - start).astype(U))
    return Words(start, end, np.searchsorted(start, texts.offsets), h)


def runs(bounds: np.ndarray, length: np.ndarray) -> np.ndarray:
    """bounds[i], bounds[i]+1, ... (length[i] of them) for every i."""
    total = int(length.sum())
    ends = np.cumsum(length)
    return np.arange(total) - np.repeat(ends - length - bounds, length)


def window_starts(bounds: np.ndarray, size: int) -> np.ndarray:
    """Positions at which a window of ``size`` values lies in one text."""
    return runs(bounds[:-1], np.maximum(np.diff(bounds) - size + 1, 0))
