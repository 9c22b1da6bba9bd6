"""Numpy arrays as binary cells, so that many small keys cross a shuffle as few rows.

The bytes of an array are stored plane by plane (all first bytes, then all second
bytes, ...): small or sorted numbers leave planes of equal bytes, which Spark's
shuffle compression removes.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa


def pack(*arrays: np.ndarray) -> bytes:
    out = [struct.pack("<B", len(arrays))]
    for a in arrays:
        out.append(struct.pack("<2sQ", a.dtype.str[1:].encode(), len(a)))
        out.append(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())
    return b"".join(out)


def unpack(cell: bytes) -> list[np.ndarray]:
    count, at, out = cell[0], 1, []
    for _ in range(count):
        kind, n = struct.unpack_from("<2sQ", cell, at)
        at += 10
        dtype = np.dtype("<" + kind.decode())
        size = n * dtype.itemsize
        planes = np.frombuffer(cell, np.uint8, size, at).reshape(dtype.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(dtype).reshape(n))
        at += size
    return out


def unpack_all(column: pa.ChunkedArray) -> tuple[list[np.ndarray], np.ndarray]:
    """The arrays of all cells end to end, and the row of each element of the first."""
    cells = [unpack(c) for c in column.to_pylist()]
    if not cells:
        return [], np.zeros(0, np.int64)
    arrays = [np.concatenate(x) for x in zip(*cells)]
    return arrays, np.repeat(np.arange(len(cells)), [len(c[0]) for c in cells])


def by_target(target: np.ndarray, *arrays: np.ndarray):
    """(target, arrays of its elements, in order) for each distinct target."""
    if not len(target):
        return
    order = np.argsort(target, kind="stable")
    t = target[order]
    cut = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
    parts = [a[order] for a in arrays]
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(t)]):
        yield int(t[a]), [p[a:b] for p in parts]
