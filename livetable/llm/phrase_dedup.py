"""Substring dedup through repeated-phrase automata.

A window is 13 consecutive words of one document.  Every word covered by a window
whose word sequence also starts in a document with a smaller doc_id is removed.

1. Anchors.  Each window is represented by the smallest hash among its six-word
   grams, so equal windows have equal anchors wherever they stand, and a document has
   about two anchors for nine words.  Each shard of documents sends (anchor, smallest
   and largest doc_id) once per anchor: a passage that a third of the documents share
   is one entry per shard.  Anchors of two documents or more go back to their shards.
2. Confirmation.  Only windows with such an anchor are hashed in full and sent, again
   pre-aggregated per shard, with one place of the shard where the window stands.  For
   windows that a smaller doc_id also has, that place and the smallest doc_id go back.
3. Automata.  The words at these places are the shard's confirmed phrases.  They are
   compiled into Aho-Corasick automata over words (at most ``PHRASES`` phrases each), and
   all documents of the shard are streamed through them.  Only the automata locate the
   occurrences; each marks its words in documents above the phrase's smallest.

The documents cross the cluster once, by shard (the exchange is used three times); a
shard is sorted by doc_id and text, so places stay valid when it is computed again.
All else is packed arrays.  Every shard is bounded in bytes, whatever copies it holds.
Windows are told apart by anchor and a 64-bit hash of the words.

Null, empty and short texts lose nothing.  A null doc_id is smaller than none and none
is smaller than it.  Rows that share a doc_id do not remove each other's words.  An
empty table gives no rows.  A document is the smallest unit of a shard, however long.  Carried
columns keep their values, whatever their names; others are ignored.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .packed import by_target, pack, unpack_all
from .spans import SPACED, Words, column_bytes, gram_hashes, inside, mix, pieces, sliding_min, tidy
from .store import shard_count

WINDOW, GRAM = 13, 6
SHARD_BYTES = 8 << 20
PHRASES = 50_000

SPANS = "spans array<struct<first:int,last:int,from:int,to:int>>"
_CELLS = pa.schema([("target", pa.int32()), ("shard", pa.int32()), ("cell", pa.binary())])


class _Windows:
    """The windows of some documents: their start words, anchors and doc_ids."""

    def __init__(self, data, offsets, i, j, ids: np.ndarray, has_id: np.ndarray, window: int):
        self.words = w = Words(data, offsets, i, j, admit=SPACED)
        self.hash = w.hashes()
        self.start = inside(w.first, window)
        doc = np.searchsorted(w.first, self.start, side="right") - 1
        keep = has_id[i:j][doc]
        self.start, doc = self.start[keep], doc[keep]
        self.anchor = sliding_min(gram_hashes(self.hash, min(GRAM, window)), window - min(GRAM, window) + 1)[self.start]
        self.doc = ids[i:j][doc]

    def only(self, chosen: np.ndarray) -> None:
        self.start, self.anchor, self.doc = self.start[chosen], self.anchor[chosen], self.doc[chosen]

    def full(self, window: int) -> np.ndarray:
        h = np.full(len(self.start), 0x51ED27, np.uint64)
        for k in range(window):
            h = mix(h ^ self.hash[self.start + k])
        return h


def _sorted(table: pa.Table) -> pa.Table:
    """The shard's rows in an order of their own, however they arrived."""
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")]) if len(table) else table


def _each(table: pa.Table, window: int):
    data, offsets = column_bytes(table["text"])
    ids = table["doc_id"].combine_chunks()
    has = ~ids.is_null().to_numpy(zero_copy_only=False) if len(ids) else np.zeros(0, bool)
    values = ids.fill_null(0).to_numpy(zero_copy_only=False)
    for i, j in pieces(offsets):
        yield i, j, _Windows(data, offsets, i, j, values, has, window)


def _lowest(keys: tuple[np.ndarray, ...], low: np.ndarray, high: np.ndarray):
    """(index of each distinct key, group of each element, smallest, largest)."""
    order = np.lexsort(keys)
    new = np.zeros(len(order), bool)
    if len(order):
        new[0] = True
        for k in keys:
            x = k[order]
            new[1:] |= x[1:] != x[:-1]
    cut = np.flatnonzero(new)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    if not len(cut):
        return order, group, low, high
    return order[cut], group, np.minimum.reduceat(low[order], cut), np.maximum.reduceat(high[order], cut)


def _cells(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    t, s, c = zip(*rows) if rows else ((), (), ())
    return pa.Table.from_arrays([pa.array(t, pa.int32()), pa.array(s, pa.int32()), pa.array(c, pa.binary())], schema=_CELLS)


def _send_anchors(targets: int, window: int):
    def run(table: pa.Table) -> pa.Table:
        found = []
        for _, _, w in _each(table, window):
            new = np.ones(len(w.start), bool)
            new[1:] = (w.anchor[1:] != w.anchor[:-1]) | (w.doc[1:] != w.doc[:-1])
            found.append((w.anchor[new], w.doc[new]))
        anchor, doc = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        first, _, low, high = _lowest((anchor,), doc, doc)
        anchor, shard = anchor[first], table["shard"][0].as_py()
        return _cells([(t, shard, pack(*x)) for t, x in by_target((mix(anchor) % np.uint64(targets)).astype(np.int64), anchor, low, high - low)])
    return run


def _repeated_anchors(table: pa.Table) -> pa.Table:
    (anchor, low, more), row = unpack_all(table["cell"])
    shard = table["shard"].to_numpy()[row]
    _, group, lowest, highest = _lowest((anchor,), low, low + more)
    again = (lowest != highest)[group]
    return _cells([(0, s, pack(a)) for s, (a,) in by_target(shard[again], anchor[again])])


def _send_windows(targets: int, window: int):
    def run(docs: pa.Table, anchors: pa.Table) -> pa.Table:
        if not len(docs) or not len(anchors):
            return _cells([])
        known = np.unique(unpack_all(anchors["cell"])[0][0])
        shard, found, before = docs["shard"][0].as_py(), [], 0
        for _, _, w in _each(_sorted(docs), window):
            w.only(_isin(w.anchor, known))
            found.append((w.anchor, w.full(window), w.doc, w.start + before))
            before += len(w.words)
        anchor, full, doc, place = (np.concatenate(x) for x in zip(*found))
        first, _, low, high = _lowest((full, anchor), doc, doc)
        anchor, full, place = anchor[first], full[first], place[first]
        place = place.astype(np.int32 if before < 1 << 31 else np.int64)
        return _cells([(t, shard, _pack_runs(*x)) for t, x in by_target((mix(anchor) % np.uint64(targets)).astype(np.int64), anchor, full, low, high - low, place)])
    return run


def _pack_runs(anchor: np.ndarray, *arrays: np.ndarray) -> bytes:
    """Elements are in order of the anchor; each anchor is stored once."""
    cut = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    return pack(arrays[0], *arrays[1:], anchor[cut], np.diff(np.append(cut, len(anchor))).astype(np.int32))


def _unpack_runs(column: pa.ChunkedArray) -> tuple[list[np.ndarray], np.ndarray]:
    arrays, row = unpack_all(column)
    *rest, anchor, times = arrays
    return [np.repeat(anchor, times), *rest], row


def _repeated_windows(table: pa.Table) -> pa.Table:
    (anchor, full, low, more, place), row = _unpack_runs(table["cell"])
    shard = table["shard"].to_numpy()[row]
    _, group, lowest, _ = _lowest((full, anchor), low, low + more)
    lowest = lowest[group]
    wanted = low + more > lowest
    lowest, place, shard = lowest[wanted], place[wanted], shard[wanted]
    order = np.argsort(place, kind="stable")
    return _cells([(0, s, pack(*x)) for s, x in by_target(shard[order], place[order], lowest[order])])


def _isin(x: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(x), bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, x), len(sorted_) - 1)] == x


def _remove(window: int, joined: bool, cleaned: bool):
    def run(docs: pa.Table, confirmed: pa.Table) -> pa.Table:
        docs = _sorted(docs)
        data, offsets = column_bytes(docs["text"])
        cover = None
        if len(docs) and len(confirmed):
            (place, lowest), _ = unpack_all(confirmed["cell"])
            cover = _occurrences(data, offsets, docs["doc_id"].to_pylist(), place, lowest, window)
        null = docs["text"].combine_chunks().is_null().to_pylist() if cleaned else []
        n, spans, out, before = [], [], [], 0
        for i, j in pieces(offsets):
            words = Words(data, offsets, i, j, admit=SPACED)
            hit = cover[before:before + len(words)] if cover is not None else None
            before += len(words)
            first = words.first.tolist()
            for d in range(j - i):
                a, b = first[d], first[d + 1]
                n.append(b - a)
                base = int(words.bounds[d])
                gone = hit[a:b] if hit is not None and hit[a:b].any() else None
                here = []
                if gone is not None:
                    edge = np.diff(np.r_[False, gone, False].astype(np.int8))
                    here = [{"first": x, "last": y, "from": int(words.starts[a + x]) - base, "to": int(words.ends[a + y - 1]) - base}
                            for x, y in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())]
                spans.append(here)
                if joined:
                    texts = data[offsets[i + d]:offsets[i + d + 1]].tobytes().split()
                    out.append(b" ".join(texts if gone is None else [x for x, g in zip(texts, gone.tolist()) if not g]))
                elif cleaned:
                    out.append(None if null[i + d] else _cut(data[offsets[i + d]:offsets[i + d + 1]].tobytes(), here))
        cols = {c: docs[c] for c in docs.column_names if c not in ("shard", "text")}
        cols |= {"n_words": pa.array(n, pa.int64()), "spans": pa.array(spans, pa.list_(pa.struct([(c, pa.int32()) for c in ("first", "last", "from", "to")])))}
        if joined or cleaned:
            cols["kept" if joined else "cleaned"] = pa.array(out, pa.binary()).cast(pa.string())
        tidy()
        return pa.table(cols)
    return run


def _cut(raw: bytes, spans: list[dict]) -> bytes:
    out, at = [], 0
    for s in spans:
        out.append(raw[at:s["from"]])
        at = s["to"]
        while at < len(raw) and raw[at:at + 1].isspace():
            at += 1
    return b"".join([*out, raw[at:]])


def _occurrences(data: np.ndarray, offsets: np.ndarray, doc_ids: list, place: np.ndarray, lowest: np.ndarray, window: int) -> np.ndarray:
    """Which of the shard's words an occurrence of a phrase with a smaller doc_id covers.
    ``place``: for each phrase, the number of a word where it begins."""
    hashes, first = [], [np.zeros(1, np.int64)]
    for i, j in pieces(offsets):
        words = Words(data, offsets, i, j, admit=SPACED)
        hashes.append(words.hashes())
        first.append(words.first[1:] + first[-1][-1])
    words, first = np.concatenate(hashes), np.concatenate(first)
    of_phrase = np.zeros(len(words) + 1, np.int32)
    np.add.at(of_phrase, place, 1)
    np.add.at(of_phrase, place + window, -1)
    text, at = _spelled(words, np.unique(words[np.cumsum(of_phrase)[:-1] > 0]))
    cover = np.zeros(len(words) + 1, np.int32)
    edges, begin = first.tolist(), at[first].tolist()
    for k in range(0, len(place), PHRASES):
        automaton, low = ahocorasick.Automaton(ahocorasick.STORE_INTS), lowest[k:k + PHRASES].tolist()
        here = place[k:k + PHRASES]
        for p, (x, y) in enumerate(zip(at[here].tolist(), at[here + window].tolist())):
            automaton.add_word(text[x:y], p)
        automaton.make_automaton()
        for d, doc in enumerate(doc_ids):
            if doc is None or edges[d + 1] - edges[d] < window:
                continue
            ends = [e for e, p in automaton.iter(text[begin[d]:begin[d + 1]]) if low[p] < doc]
            if ends:
                e = np.searchsorted(at[edges[d]:edges[d + 1]], np.array(ends) + begin[d], side="right") - 1 + edges[d]
                cover[e - window + 1] += 1
                cover[e + 1] -= 1
    return np.cumsum(cover)[:-1] > 0


def _spelled(words: np.ndarray, vocabulary: np.ndarray) -> tuple[str, np.ndarray]:
    """The words as a string, and where each begins in it (with the end).  A word of the
    vocabulary is two letters, its number's digits, each digit with letters of its
    own, so words never overlap; any other word is one letter.  The automaton looks
    through a node's letters one by one, so few letters keep its steps short."""
    n = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
    known = vocabulary[n] == words
    base = round(len(vocabulary) ** 0.5) + 1
    at = np.concatenate([[0], np.cumsum(np.where(known, 2, 1))])
    letters = np.ones(int(at[-1]), np.uint32)
    k = at[:-1][known]
    for place, digit in enumerate((n // base, n % base)):
        letters[k + place] = 2 + place * base + digit[known]
    letters[letters >= 0xD800] += 0x800     # no surrogates
    return letters.tobytes().decode("utf-32-le"), at


def repeated_phrases(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
                     joined: bool = False, cleaned: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_words, spans) for every row of ``docs``, with the columns ``carry``.

    spans: removed words, as word numbers [first, last) and byte offsets [from, to).
    ``joined``: also ``kept``, the kept words joined by one space; ``cleaned``: also
    ``cleaned``, the text without the spans and the white space after each.
    """
    shards = shard_count(docs, text, SHARD_BYTES)
    names = {c: f"carry_{k}" for k, c in enumerate(carry)}
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                       *[F.col(c).alias(a) for c, a in names.items()])
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int")) \
        .repartition(shards, "shard")
    keyed = rows.select("doc_id", "text", "shard") if not carry else rows
    cells = "target int, shard int, cell binary"
    anchors = rows.groupBy("shard").applyInArrow(_send_anchors(shards, window), cells) \
        .groupBy("target").applyInArrow(_repeated_anchors, cells)
    windows = keyed.groupBy("shard").cogroup(anchors.groupBy("shard")).applyInArrow(_send_windows(shards, window), cells) \
        .groupBy("target").applyInArrow(_repeated_windows, cells)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    out = rows.groupBy("shard").cogroup(windows.groupBy("shard")).applyInArrow(
        _remove(window, joined, cleaned), ", ".join(f"{c} {kinds[c]}" for c in ("doc_id", *names.values())) + f", n_words long, {SPANS}"
        + ", kept string" * joined + ", cleaned string" * (cleaned and not joined))
    return out.select("doc_id", *[F.col(a).alias(c) for c, a in names.items()], *[c for c in out.columns if c != "doc_id" and c not in names.values()])
