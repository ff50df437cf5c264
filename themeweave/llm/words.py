"""Words, word hashes and word windows of whole Arrow string columns at once.

A word is ``[^\\x20\\x09-\\x0D]+``. Those separators are single bytes in UTF-8, so all
work is done on bytes. Documents are handled in blocks of about ``BLOCK`` bytes,
never cut: a longer document is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 1 << 19

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BYTE_BASE = np.uint64(0x9E3779B97F4A7C55)
_WORD_BASE = np.uint64(0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xA0761D6478BD642F)
    x ^= x >> np.uint64(32)
    return x


_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_CODES_LOWER = _CODES[LOWER]


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, as many as asked for so far."""

    def __init__(self, base: np.uint64):
        self.base = base
        self.inverse = np.uint64(pow(int(base), -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up, self.down = (np.full(size, b, np.uint64) for b in (self.base, self.inverse))
            self.up[0] = self.down[0] = 1
            np.multiply.accumulate(self.up, out=self.up)
            np.multiply.accumulate(self.down, out=self.down)
        return self.up[:n], self.down[:n]


_BYTE_POWERS, _WORD_POWERS = _Powers(_BYTE_BASE), _Powers(_WORD_BASE)


def sums_between(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sums of values[start:end], wrapping for unsigned integers."""
    total = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=total[1:])
    return total[end] - total[start]


@dataclass
class Block:
    """Some documents' bytes and where their words are."""

    low: int  # number of the first document in the batch
    data: np.ndarray  # uint8
    offsets: np.ndarray  # byte offsets of the documents, one more than there are
    start: np.ndarray  # byte ranges of the words
    end: np.ndarray
    first: np.ndarray  # number of each document's first word, one more than there are

    @property
    def documents(self) -> int:
        return len(self.offsets) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """Document of each word."""
        return np.repeat(np.arange(self.documents), self.counts())

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of each word, of its lower-cased (A-Z) form if asked for."""
        up, down = _BYTE_POWERS.get(len(self.data) + 1)
        coded = (_CODES_LOWER if lower else _CODES)[self.data]
        coded *= up[: len(self.data)]
        return mix(sums_between(coded, self.start, self.end) * down[self.start] + (self.end - self.start).astype(np.uint64))

    def windows(self, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all windows of ``size`` words inside one document, and the windows' hashes."""
        counts = self.counts()
        each = np.maximum(counts - size + 1, 0)
        at = np.arange(each.sum()) + np.repeat(self.first[:-1] - (np.cumsum(each) - each), each)
        return at, window_hashes(hashes, at, size)


def window_hashes(hashes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    up, down = _WORD_POWERS.get(len(hashes) + 1)
    return mix(sums_between(hashes * up[: len(hashes)], at, at + size) * down[at])


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets and bytes of a string column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def spans(column: pa.Array, block: int = BLOCK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of whole documents: number of the first, byte offsets from 0, bytes."""
    if not len(column):
        return
    offsets, data = string_buffers(column)
    low, n = 0, len(column)
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + block, "right")) - 1)
        yield low, offsets[low : high + 1] - offsets[low], data[offsets[low] : offsets[high]]
        low = high


def blocks(column: pa.Array, block: int = BLOCK) -> Iterator[Block]:
    for low, offsets, data in spans(column, block):
        yield cut(low, offsets, data, SPACE)


def cut(low: int, offsets: np.ndarray, data: np.ndarray, separator: np.ndarray) -> Block:
    """The pieces of the documents between separator bytes, as words of a block."""
    word = ~separator[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before[inner], after[inner - 1] = False, False
    start, end = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    return Block(low, data, offsets, start, end, np.searchsorted(start, offsets))
