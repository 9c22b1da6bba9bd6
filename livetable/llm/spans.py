"""Words of Arrow text columns as numpy arrays.

The operators here work on whole Arrow batches: a text column is one byte
buffer with document offsets, words are runs of the bytes a 256-entry table
admits, and word keys are 64-bit hashes of their bytes.  All word patterns of
this package are defined on ASCII bytes, so UTF-8 needs no decoding.  Batches are
walked in pieces of a few megabytes of whole documents, so memory stays small
whatever the batch size is.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

PIECE_BYTES = 4 << 20
_LONG = 256  # longer words are hashed one by one
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)

IDENTITY = np.arange(256, dtype=np.uint8)
LOWER = IDENTITY.copy()
LOWER[0x41:0x5B] += 0x20  # A-Z

SPACED = np.ones(256, dtype=bool)  # [^\x20\x09-\x0D]
SPACED[[0x20, *range(0x09, 0x0E)]] = False

ALNUM = np.zeros(256, dtype=bool)  # [^\x00-\x2F\x3A-\x60\x7B-\x7F]
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(32))
    x = x * _K2
    x = x ^ (x >> np.uint64(29))
    x = x * _K1
    return x ^ (x >> np.uint64(32))


def column_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null rows have no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    col = column.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset:col.offset + len(col) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf, offsets


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents of at most ``limit`` bytes; a longer document alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def tidy() -> None:
    """Give freed memory back to the system: a worker that Spark keeps for later tasks
    would hold on to the largest that it ever used."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):   # not glibc
        pass


class Words:
    """Words of documents i..j of a column.

    ``starts``/``ends``: byte spans in ``buf`` (the documents' bytes, mapped
    through ``fold``, then zeros); ``first``: index of each document's first word,
    with the total at the end; ``base``: byte offset of ``buf`` in the column.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, i: int, j: int,
                 fold: np.ndarray = IDENTITY, admit: np.ndarray = SPACED):
        lo, hi = int(offsets[i]), int(offsets[j])
        self.base = lo
        raw = data[lo:hi]
        self.buf = np.zeros(hi - lo + 8, dtype=np.uint8)
        self.buf[:hi - lo] = raw if fold is IDENTITY else fold[raw]
        self.bounds = offsets[i:j + 1] - lo
        ok = admit[self.buf[:hi - lo]]
        begin, last = ok.copy(), ok.copy()
        begin[1:] &= ~ok[:-1]
        last[:-1] &= ~ok[1:]
        cut = self.bounds[(self.bounds > 0) & (self.bounds < hi - lo)]
        begin[cut], last[cut - 1] = ok[cut], ok[cut - 1]
        self.starts = np.flatnonzero(begin)
        self.ends = np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.starts, self.bounds)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, seed: int = 0) -> np.ndarray:
        return hash_spans(self.buf, self.starts, self.ends - self.starts, seed)

    def word(self, k: int) -> bytes:
        return self.buf[self.starts[k]:self.ends[k]].tobytes()


def load8(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Little-endian 8-byte numbers at any byte positions (8 bytes must follow)."""
    out = buf[at].astype(np.uint64)
    for k in range(1, 8):
        out |= buf[at + k].astype(np.uint64) << np.uint64(8 * k)
    return out


def hash_spans(buf: np.ndarray, starts: np.ndarray, lens: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each byte span; ``buf`` has 8 spare bytes at its end."""
    h = (lens.astype(np.uint64) + np.uint64(seed)) * _K2
    todo, at = None, 0
    s, n = starts, lens
    while len(s):
        block = load8(buf, s + at if at else s) & _MASK[np.minimum(n - at, 8)]
        if todo is None:
            h = (h ^ block) * _K1
            h ^= h >> np.uint64(31)
            todo = np.flatnonzero((lens > 8) & (lens <= _LONG))
        else:
            x = (h[todo] ^ block) * _K1
            h[todo] = x ^ (x >> np.uint64(31))
            todo = todo[lens[todo] > at + 8]
        at += 8
        s, n = starts[todo], lens[todo]
    for k in np.flatnonzero(lens > _LONG):
        h[k] = xxhash.xxh3_64_intdigest(buf[starts[k]:starts[k] + lens[k]].tobytes(), seed=seed)
    return mix(h)


def gram_hashes(words: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of every k consecutive word hashes: entry i covers words i..i+k-1."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, (seed * 0x9E3779B97F4A7C15 + k) & (2**64 - 1), dtype=np.uint64)
    for j in range(k):
        h = (h ^ words[j:j + n]) * _K1
        h ^= h >> np.uint64(32)
    return mix(h)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive entries."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    span = 1
    while span * 2 <= w:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:n], x[w - span:w - span + n])


def inside(first: np.ndarray, k: int) -> np.ndarray:
    """Starts i of the windows i..i+k-1 that lie within one document."""
    counts = np.diff(first)
    room = np.maximum(counts - k + 1, 0)
    total = int(room.sum())
    ends = np.cumsum(room)
    return np.arange(total) - np.repeat(ends - room, room) + np.repeat(first[:-1], room)
