"""Vectorised work on the UTF-8 bytes of a batch of texts (runs inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import SEPARATORS

BLOCK = 1 << 20
_POSITIONS = 128


def text_blocks(column: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of runs of rows with about ``limit`` bytes; null is empty.

    A run has at least one row; a longer text is a run of its own.
    """
    column = column.cast(pa.large_string()).fill_null("")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, dtype=np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        hi = min(hi, len(column))
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def lower_table() -> np.ndarray:
    """Maps A-Z to a-z and every other byte to itself."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def separator_table() -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    t[list(SEPARATORS)] = True
    return t


def mix(v: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser; changes ``v`` in place."""
    v ^= v >> np.uint64(30)
    v *= np.uint64(0xBF58476D1CE4E5B9)
    v ^= v >> np.uint64(27)
    v *= np.uint64(0x94D049BB133111EB)
    v ^= v >> np.uint64(31)
    return v


def _position_table() -> np.ndarray:
    return mix(np.arange(1, 256 * _POSITIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Words:
    """Splits blocks into words and hashes them to 64 bits; equal words have equal hashes in every task."""

    def __init__(self, lower: bool = True):
        self.lower = lower_table() if lower else None
        self.separator = separator_table()
        self.table = _position_table()

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hash of each word, number of words up to each text's end with a leading 0)."""
        if not len(data):
            return np.zeros(0, dtype=np.uint64), np.zeros(len(offsets), dtype=np.int64)
        if self.lower is not None:
            data = self.lower[data]
        word = ~self.separator[data]
        start = word.copy()
        start[1:] &= ~word[:-1]
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]
        start[heads] = word[heads]
        first = np.flatnonzero(start)
        counts = np.searchsorted(first, offsets)
        at = np.flatnonzero(word)
        if not len(at):
            return np.zeros(0, dtype=np.uint64), counts
        begins = np.searchsorted(at, first)
        lengths = np.diff(np.append(begins, len(at)))
        pos = at - np.repeat(first, lengths)
        part = self.table[(pos & (_POSITIONS - 1)) * 256 + data[at]]
        if pos.max() >= _POSITIONS:
            part *= (pos // _POSITIONS).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        sums = np.add.reduceat(part, begins)
        return mix(sums + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), counts


def grams(data: np.ndarray, n: int) -> np.ndarray:
    """The n bytes from each position as a number (n up to 8); empty if there are fewer."""
    if len(data) < n:
        return np.zeros(0, dtype=np.uint64)
    out = data[: len(data) - n + 1].astype(np.uint64)
    for k in range(1, n):
        out |= data[k : len(data) - n + 1 + k].astype(np.uint64) << np.uint64(8 * k)
    return out


def gram_spans(offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each text: its first n-gram position and the position after its last."""
    return offsets[:-1], np.maximum(offsets[1:] - (n - 1), offsets[:-1])


def bucket(v: np.ndarray, bits: int, salt: int) -> np.ndarray:
    """Multiply-shift hash to ``bits`` bits."""
    odd = np.uint64((0x9E3779B97F4A7C15 * (2 * salt + 1)) % 2**64 | 1)
    return ((v + np.uint64(salt)) * odd) >> np.uint64(64 - bits)
