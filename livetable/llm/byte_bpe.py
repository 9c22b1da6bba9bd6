"""Byte-level BPE by monoid tree reduction.

Text is cut by the tokenizer's split pattern and each part is encoded by itself.  A
part's bytes are halved down to short leaves, which are merged by rank; two encoded
neighbours are joined by re-encoding a window of tokens at their boundary and growing
it until the tokens outside provably stay as they are.

Why that is exact: a token sequence is the encoding of its bytes if and only if every
two neighbouring tokens, encoded together, give just these two (``_fits``).  Inside the
left part, the window and the right part this holds already; so only the pairs at the
window's two ends need the test, and a window whose ends pass is final.

Splitting is vectorised: ``SPLIT`` is applied through character classes on whole
batches, so no regular expression runs over the text, and a part that occurs many
times in a batch is encoded once.  Decoding concatenates token bytes: token lengths
are summed up (a scan), then all bytes are gathered at once.

Null and empty texts have no tokens.  Bytes that are not UTF-8 are read as U+FFFD.  Ties
of rank cannot arise.  Every row is encoded by itself, repeated rows too; an empty table gives
no rows.  A long text is a piece of its own.  Carried columns keep their values, whatever
their names; others are ignored.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .spans import _MASK, column_bytes, hash_spans, load8, pieces, tidy

LEAF = 8                # bytes merged by rank directly
CACHE_BYTES = 20 << 20  # encoded parts kept in each of two generations, as ``_cost`` counts them
PAIRS = 100_000         # tested token pairs kept
BATCH_BYTES = 2 << 20
MAX_VOCABULARY_BYTES = 64 << 20  # the broadcast's bound

#: The split pattern whose classes ``part_starts`` follows (fixed value).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

OTHER, LETTER, NUMBER, WHITE, BLANK = range(5)


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank of a ``.tiktoken`` file (base64 token, blank, rank)."""
    with open(path, "rb") as f:
        raw = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(raw) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path}: a vocabulary of over {MAX_VOCABULARY_BYTES} bytes is not broadcast")
    return {base64.b64decode(t): int(r) for t, r in (line.split() for line in raw.splitlines() if line)}


_classes: np.ndarray | None = None


def char_classes() -> np.ndarray:
    """Class of every code point, by the properties the pattern names."""
    global _classes
    if _classes is None:
        table = np.zeros(0x110000, np.uint8)
        every = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "\0" for c in range(0x110000))
        for cls, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (WHITE, r"\p{White_Space}+")):
            for m in regex.finditer(pattern, every):
                table[m.start():m.end()] = cls
        table[0x20] = BLANK
        _classes = table
    return _classes


def part_starts(points: np.ndarray, doc_starts: np.ndarray) -> np.ndarray:
    """Positions at which a match of SPLIT begins, for documents laid end to end.

    The rules, in the pattern's terms: a run of letters, of numbers or of other
    characters begins anew unless a blank before it belongs to it; a run of white
    space gives its last character to what follows (as that blank, or alone); an
    apostrophe that begins a part takes s, t, re, ve, m, ll or d with it.
    """
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    c = char_classes()[points]
    begin = np.zeros(n, bool)
    begin[doc_starts[doc_starts < n]] = True
    white = c >= WHITE
    prev = np.empty_like(c)
    prev[0], prev[1:] = 255, c[:-1]
    prev[begin] = 255
    start = begin | ((c != prev) & ~white & (prev != BLANK))
    follows = np.zeros(n, bool)     # a non-white character of the same document comes next
    follows[:-1] = ~white[1:] & ~begin[1:]
    prev_white = (prev >= WHITE) & (prev != 255)
    start |= white & (~prev_white | follows)

    quote = np.flatnonzero((points == 0x27) & (start | begin))
    if len(quote):
        end_of = np.append(doc_starts[1:], n) if len(doc_starts) else np.array([n])
        room = end_of[np.searchsorted(doc_starts, quote, side="right") - 1] - quote
        a = np.where(room > 1, points[np.minimum(quote + 1, n - 1)], 0)
        b = np.where(room > 2, points[np.minimum(quote + 2, n - 1)], 0)
        one = np.isin(a, [ord(x) for x in "stmd"])
        two = ~one & (((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l"))))
        hit = one | two
        q, size = quote[hit], np.where(one, 2, 3)[hit]
        start[q + 1] = False
        after = q + size
        after = after[(after < n)]
        # What follows the contraction begins anew; white space does so by itself
        # unless a longer run of it hands over only its last character.
        start[after[~white[after]]] = True
    return np.flatnonzero(start)


def _cost(part: bytes, ids: tuple) -> int:
    """Bytes that a cached part takes: two objects and a dictionary slot (the numbers are the vocabulary's)."""
    return 150 + len(part) + 8 * len(ids)


class Encoder:
    """Encodes parts; one per worker, with bounded memory."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values(), default=-1) + 1
        self.token = [b""] * self.size
        for t, r in ranks.items():
            self.token[r] = t
        self.held = 0
        self.new: dict[bytes, tuple] = {}
        self.old: dict[bytes, tuple] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    def merge(self, part: bytes) -> tuple[int, ...]:
        """Plain BPE: the adjacent pair of lowest rank first, leftmost on ties."""
        ranks = self.ranks
        if len(part) == 1:
            return (ranks[part],)
        bits = [part[k:k + 1] for k in range(len(part))]
        best = [ranks.get(part[k:k + 2], 1 << 60) for k in range(len(part) - 1)]
        while best:
            low = min(best)
            if low == 1 << 60:
                break
            k = best.index(low)
            bits[k:k + 2] = [bits[k] + bits[k + 1]]
            del best[k]
            if k < len(best):
                best[k] = ranks.get(bits[k] + bits[k + 1], 1 << 60)
            if k:
                best[k - 1] = ranks.get(bits[k - 1] + bits[k], 1 << 60)
        return tuple([ranks[b] for b in bits])

    def _fits(self, a: int, b: int) -> bool:
        """Tokens a and b side by side stay two tokens."""
        found = self.pairs.get((a, b))
        if found is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            found = self.pairs[a, b] = self.merge(self.token[a] + self.token[b]) == (a, b)
        return found

    def join(self, x: tuple, y: tuple) -> tuple:
        if self._fits(x[-1], y[0]):
            return x + y
        i = j = 1
        while True:
            i, j = min(i, len(x)), min(j, len(y))
            window = self.merge(b"".join([self.token[t] for t in x[len(x) - i:] + y[:j]]))
            left = i == len(x) or self._fits(x[-i - 1], window[0])
            right = j == len(y) or self._fits(window[-1], y[j])
            if left and right:
                return x[:len(x) - i] + window + y[j:]
            i, j = i if left else 2 * i, j if right else 2 * j

    def reduce(self, part: bytes) -> tuple[int, ...]:
        """Encode both halves, join them; leaves are merged by rank."""
        if len(part) <= LEAF:
            return self.merge(part)
        half = len(part) // 2
        return self.join(self.known(part[:half]), self.known(part[half:]))

    def known(self, part: bytes) -> tuple[int, ...]:
        found = self.new.get(part)
        if found is None:
            found = self.old.get(part)
            if found is None:
                found = self.reduce(part)
            if len(part) <= 64:
                self.held += _cost(part, found)
                if self.held > CACHE_BYTES:
                    self.old, self.new, self.held = self.new, {}, _cost(part, found)
                self.new[part] = found
        return found

    def encode(self, part: bytes) -> tuple[int, ...]:
        """A part that is a token by itself is that token."""
        whole = self.ranks.get(part)
        return (whole,) if whole is not None else self.known(part)


def encode_texts(data: np.ndarray, offsets: np.ndarray, i: int, j: int, encoder: Encoder) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of the documents i..j of a column."""
    lo, hi = int(offsets[i]), int(offsets[j])
    raw = data[lo:hi]
    bounds = offsets[i:j + 1] - lo
    try:
        text = raw.tobytes().decode("utf-8")
    except UnicodeDecodeError:
        docs = [raw[a:b].tobytes().decode("utf-8", "replace").encode() for a, b in zip(bounds[:-1], bounds[1:])]
        raw = np.frombuffer(b"".join(docs), np.uint8)
        bounds = np.cumsum([0, *map(len, docs)])
        text = raw.tobytes().decode("utf-8")
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    buf = np.zeros(len(raw) + 8, np.uint8)
    buf[:len(raw)] = raw
    at = np.flatnonzero((raw & 0xC0) != 0x80)       # byte position of each code point
    docs = np.searchsorted(at, bounds[:-1])
    begin = at[part_starts(points, np.unique(docs))] if len(points) else np.zeros(0, np.int64)
    size = np.diff(np.append(begin, len(raw)))
    key = hash_spans(buf, begin, size)
    _, rep, inv = np.unique(key, return_index=True, return_inverse=True)
    # Parts of one hash are one part only if their bytes agree.
    stray = _differing(buf, begin, size, rep[inv])
    parts = [buf[a:a + s].tobytes() for a, s in zip(begin[rep].tolist(), size[rep].tolist())]
    if len(stray):
        inv[stray] = len(parts) + np.arange(len(stray))
        parts += [buf[a:a + s].tobytes() for a, s in zip(begin[stray].tolist(), size[stray].tolist())]
    coded = [encoder.encode(p) for p in parts]
    count = np.fromiter(map(len, coded), np.int64, len(coded))
    flat = np.fromiter((t for c in coded for t in c), np.int32, int(count.sum()))
    from_ = np.cumsum(count) - count
    per = count[inv]
    ends = np.cumsum(per)
    total = int(ends[-1]) if len(ends) else 0
    ids = flat[np.repeat(from_[inv] - (ends - per), per) + np.arange(total)]
    cut = np.searchsorted(begin, bounds)
    return ids, np.append(0, ends)[cut]


def _differing(buf, begin, size, rep) -> np.ndarray:
    """Parts whose bytes are not those of the part ``rep`` names."""
    bad = size != size[rep]
    todo, at = np.flatnonzero(~bad & (rep != np.arange(len(rep)))), 0
    while len(todo):
        mask = _MASK[np.minimum(size[todo] - at, 8)]
        x = load8(buf, begin[todo] + at) & mask
        bad[todo] |= x != (load8(buf, begin[rep[todo]] + at) & mask)
        at += 8
        todo = todo[size[todo] > at]
    return np.flatnonzero(bad)


class Decoder:
    def __init__(self, ranks: dict[bytes, int]):
        n = max(ranks.values(), default=-1) + 1
        token = [b""] * n
        for t, r in ranks.items():
            token[r] = t
        self.size = np.fromiter(map(len, token), np.int64, n)
        self.at = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(token), np.uint8)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets) of documents given as ids with document offsets."""
        size = self.size[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        out = self.bytes[np.repeat(self.at[ids] - (ends - size), size) + np.arange(total)]
        return out, np.append(0, ends)[offsets]


def _run(source, decode: bool):
    tools: dict = {}

    def run(batches):
        if not tools:
            ranks = source.value
            tools.update(encoder=Encoder(ranks), decoder=Decoder(ranks))
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            for i, j in pieces(offsets, BATCH_BYTES):
                ids, cut = encode_texts(data, offsets, i, j, tools["encoder"])
                names = [c for c in batch.schema.names if c != "text"]
                cols = [batch.column(c).slice(i, j - i) for c in names]
                cols.append(pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(ids)))
                if decode:
                    raw, at = tools["decoder"].decode(ids, cut)
                    cols.append(pa.LargeBinaryArray.from_buffers(
                        pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64).tobytes()), pa.py_buffer(raw.tobytes())]
                    ).cast(pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=names + ["ids", "decoded"][:len(cols) - len(names)])
        tools.clear()
        tidy()
    return run


def encode(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", decode: bool = False,
           carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, *carry, ids array<int>) of every row, and with ``decode`` the bytes that
    the ids decode to (decoded binary).  ``vocabulary``: path of a rank file."""
    ranks = load_ranks(vocabulary)
    source = docs.sparkSession.sparkContext.broadcast(ranks)
    names = {c: f"carry_{k}" for k, c in enumerate(carry)}
    rows = docs.select(F.col(doc_id).alias("doc_id"), *[F.col(c).alias(a) for c, a in names.items()],
                       F.col(text).cast("string").alias("text"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    out = rows.mapInArrow(_run(source, decode), f"{kinds}, ids array<int>" + ", decoded binary" * decode)
    return out.select("doc_id", *[F.col(a).alias(c) for c, a in names.items()], "ids", *["decoded"] * decode)
