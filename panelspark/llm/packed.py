"""Packed rows: the entries that a task has for one partition of a key space, as arrays in one row.

A shuffle of hundreds of millions of entries then has a few rows for each
task and partition. (part, kind, block, a, b): ``a`` and ``b`` hold the
arrays of the row's kind as bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PACKED = "part int, kind int, block long, a binary, b binary"


def packed_rows(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
    cols = list(zip(*rows)) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, types)], names=["part", "kind", "block", "a", "b"])


def split(part: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """(partition, positions) of every partition that occurs."""
    order = np.argsort(part.astype(np.uint16) if parts <= 1 << 16 else part, kind="stable")
    ends = np.cumsum(np.bincount(part, minlength=parts))
    start = 0
    for p, end in enumerate(ends.tolist()):
        if end > start:
            yield p, order[start:end]
        start = end


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Partition of each key, from the high bits of a multiplicative hash."""
    spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((spread >> np.uint64(40)) % np.uint64(parts)).astype(np.int64)


def unpack(table: pa.Table, kind: int, types: tuple) -> list[tuple]:
    """(block, a, b) of the rows of a kind, as arrays."""
    rows = zip(table["kind"].to_pylist(), table["block"].to_pylist(), table["a"], table["b"])
    return [(block, np.frombuffer(a.as_py(), types[0]), np.frombuffer(b.as_py(), types[1])) for k, block, a, b in rows if k == kind]
