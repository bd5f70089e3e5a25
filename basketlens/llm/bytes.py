"""Byte-level helpers for functions that run inside Spark tasks: blocks of texts, words, hashes.

All of them work on Arrow buffers with numpy, a bounded block of documents at a time, so that a task
holds one block (or one document, if that is longer) and never a whole partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that one step handles at a time; a longer document makes a block of its own.
BLOCK_BYTES = 1 << 19

_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finalizer of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def constants(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit numbers fixed by the seed."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed)) | np.uint64(1)


def byte_values(seed: int, lower: bool) -> np.ndarray:
    """A random 64-bit value for each byte; with lower, A-Z have the values of a-z."""
    values = constants(256, seed)
    if lower:
        values[65:91] = values[97:123]
    return values


class SpanHasher:
    """64-bit hashes of spans of a block's bytes, the same wherever a span stands.

    One object serves one task; its tables of powers grow to the longest block that it has seen.
    """

    def __init__(self, seed: int, lower: bool = False) -> None:
        self.values = byte_values(seed, lower)
        self.powers = self.inverse = np.ones(1, np.uint64)

    def read(self, buf: np.ndarray) -> None:
        """Take the bytes whose spans are hashed next."""
        if len(self.powers) <= len(buf):
            size = 1 << max(20, len(buf).bit_length())
            base = np.full(size, _BASE, np.uint64)
            base[0] = 1
            self.powers = np.cumprod(base, dtype=np.uint64)
            base[1:] = pow(_BASE, -1, 1 << 64)
            self.inverse = np.cumprod(base, dtype=np.uint64)
        self.sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(self.values[buf] * self.powers[: len(buf)], out=self.sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts])


def binary_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A text or binary column as binary, null as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    if not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary())
    return column.fill_null(b"") if column.null_count else column


def blocks(column: pa.Array, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Blocks of consecutive rows: first row, row after the last, their bytes, offsets of the rows in them."""
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    low = 0
    while low < len(column):
        high = int(np.searchsorted(offsets, offsets[low] + most, "right")) - 1
        high = min(max(high, low + 1), len(column))
        high = min(high, low + 4096)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def word_spans(buf: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a block, and per document the number of words before it."""
    inside = is_word[buf]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = offsets[:-1] < offsets[1:]
    heads, tails = offsets[:-1][full], offsets[1:][full] - 1
    first[heads] = inside[heads]
    last[tails] = inside[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """True for the bytes in the ranges (both ends included)."""
    chosen = np.zeros(256, bool)
    for low, high in ranges:
        chosen[low : high + 1] = True
    return chosen
