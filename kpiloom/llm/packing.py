"""Columns of 64-bit numbers as one byte string, for rows that carry whole sorted arrays.

The first column is in ascending order and held by its differences, the others by their distance from
their smallest value. Each is cut into its bytes, lowest first, up to the highest one in use; that one
takes few values and is compressed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def packed(*columns: np.ndarray) -> bytes:
    """``columns`` of one length, the first in ascending order, as bytes."""
    n = len(columns[0])
    out = [np.uint32(n).tobytes()]
    for i, column in enumerate(columns):
        column = np.ascontiguousarray(column).astype(np.int64, copy=False).view(np.uint64)
        base = column[:1].copy() if i == 0 else np.array([column.view(np.int64).min()] if n else [], np.int64).view(np.uint64)
        rest = np.diff(column, prepend=base) if i == 0 else column - base
        used = (int(rest.max(initial=0)).bit_length() + 7) // 8
        planes = np.ascontiguousarray(rest).view(np.uint8).reshape(n, 8)[:, :used].T
        top = pa.compress(planes[-1].tobytes(), "zstd", asbytes=True) if used else b""
        out += [base.tobytes(), np.array([used, len(top)], np.uint32).tobytes(), planes[:-1].tobytes() if used else b"", top]
    return b"".join(out)


def unpacked(data: bytes, columns: int) -> list[np.ndarray]:
    """What ``packed`` was given, as unsigned numbers."""
    n, at, out = int(np.frombuffer(data, np.uint32, 1)[0]), 4, []
    for i in range(columns):
        base = np.frombuffer(data, np.uint64, min(n, 1), at)
        at += base.nbytes
        used, length = (int(x) for x in np.frombuffer(data, np.uint32, 2, at))
        at += 8
        rest = np.zeros((n, 8), np.uint8)
        if used:
            low = n * (used - 1)
            rest[:, : used - 1] = np.frombuffer(data, np.uint8, low, at).reshape(used - 1, n).T
            at += low
            top = pa.decompress(data[at : at + length], n, "zstd", asbytes=True)
            rest[:, used - 1] = np.frombuffer(top, np.uint8)
            at += length
        rest = rest.view(np.uint64).reshape(n)
        out.append((np.cumsum(rest, dtype=np.uint64) if i == 0 else rest) + base if n else rest)
    return out
