"""Benchmark decontamination through an FM-index per training shard.

A phrase is a window of consecutive words of a benchmark item (the whole item where
it has fewer words).  Words are runs of ASCII letters and digits and of all
non-ASCII bytes, with A-Z lower-cased.  Each shard (two megabytes of whole
documents) is indexed once: words that no phrase has are separators, and runs
shorter than the shortest phrase are left out, for they can hold no occurrence.  All
phrases are searched backward through the index, occurrences are located by sampled
suffix positions, and their spans are merged for each document.

The benchmark is read in blocks of ``BLOCK_BYTES`` at most (an item is the smallest
unit), each broadcast by itself; a larger benchmark takes several passes.  Items of one
text may lie in several blocks, as each item's id is matched by itself.  Documents are only mapped: no shuffle.
Words are compared by 64-bit hash.

Null and empty texts have no words, no spans and no items.  Items without words have
no phrase.  The spans of an item whose id is null count, but it is not listed.
Repeated items count once.  Repeated documents are judged one by one.  Without documents there
are no rows, without items no hits.  A long document is a shard of its own.  Carried columns keep
their values, whatever their names; others are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .fm_index import FMIndex
from .spans import ALNUM, LOWER, Words, column_bytes, pieces, tidy
from .store import settle

WINDOW = 10
BLOCK_BYTES = 8 << 20
BINS = 16           # hash bins for each block, which are packed to blocks by their bytes
SHARD_BYTES = 2 << 20

SPANS = "spans array<struct<first:int,last:int,from:int,to:int>>"


def phrases(texts: list[str | None], ids: list[str | None], window: int = WINDOW) -> dict | None:
    """Compiled phrases: the vocabulary's sorted hashes, the distinct phrases as rows
    of symbols (1 + place in the vocabulary) set at the right end, and their items."""
    data, offsets = column_bytes(pa.array(texts, pa.string()))
    rows, owner = [], []
    for i, j in pieces(offsets):
        w = Words(data, offsets, i, j, LOWER, ALNUM)
        h = w.hashes()
        for d, (a, b) in enumerate(zip(w.first[:-1].tolist(), w.first[1:].tolist())):
            for k in range(a, max(b - window + 1, a + (b > a))):
                rows.append(h[k:min(k + window, b)])
                owner.append(i + d)
    if not rows:
        return None
    vocabulary = np.unique(np.concatenate(rows))
    lengths = np.array([len(r) for r in rows])
    table = np.zeros((len(rows), window), np.int64)
    for k, r in enumerate(rows):
        table[k, window - len(r):] = np.searchsorted(vocabulary, r) + 1
    table, inverse = np.unique(table, axis=0, return_inverse=True)
    pairs = np.unique(np.stack([inverse.ravel(), np.array(owner)], axis=1), axis=0)
    return {"vocabulary": vocabulary, "table": table, "lengths": (table > 0).sum(axis=1),
            "shortest": int(lengths.min()), "ids": ids,
            "from": np.searchsorted(pairs[:, 0], np.arange(len(table) + 1)), "owners": pairs[:, 1]}


def find(data: np.ndarray, offsets: np.ndarray, i: int, j: int, p: dict) -> tuple[Words, np.ndarray, np.ndarray]:
    """Documents i..j: their words, which words an occurrence covers, and the distinct
    (document, item) pairs."""
    w = Words(data, offsets, i, j, LOWER, ALNUM)
    cover = np.zeros(len(w) + 1, np.int32)
    none = np.zeros((0, 2), np.int64)
    if not len(w):
        return w, cover[:-1] > 0, none
    h = w.hashes()
    vocabulary = p["vocabulary"]
    place = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
    known = vocabulary[place] == h
    # Runs of known words within a document, long enough for a phrase.
    first = known.copy()
    first[1:] &= ~known[:-1]
    last = known.copy()
    last[:-1] &= ~known[1:]
    heads = w.first[1:-1][(w.first[1:-1] > 0) & (w.first[1:-1] < len(w))]
    first[heads], last[heads - 1] = known[heads], known[heads - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    long = end - begin >= p["shortest"]
    begin, end = begin[long], end[long]
    if not len(begin):
        return w, cover[:-1] > 0, none
    size = end - begin
    at = np.cumsum(size + 1) - size         # place of each run behind its separator
    text = np.zeros(int(size.sum()) + len(size) + 1, np.int32)
    source = np.zeros(len(text), np.int32)
    inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    to, word = np.repeat(at, size) + inner, np.repeat(begin, size) + inner
    text[to], source[to] = place[word] + 1, word
    index = FMIndex(text, len(vocabulary) + 1)
    lo, hi = index.search(p["table"], p["lengths"])
    found = np.flatnonzero(hi > lo)
    times = (hi - lo)[found]
    if not len(found):
        return w, cover[:-1] > 0, none
    which = np.repeat(found, times)
    rows = np.repeat(lo[found] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
    words = source[index.locate(rows)]
    np.add.at(cover, words, 1)
    np.add.at(cover, words + p["lengths"][which], -1)
    doc = np.searchsorted(w.first, words, side="right") - 1
    pairs = np.unique(np.stack([doc, which], axis=1), axis=0)
    many = p["from"][pairs[:, 1] + 1] - p["from"][pairs[:, 1]]
    places = np.repeat(p["from"][pairs[:, 1]] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
    owners = np.unique(np.stack([np.repeat(pairs[:, 0], many), p["owners"][places]], axis=1), axis=0)
    return w, np.cumsum(cover)[:-1] > 0, owners


def _spans(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.r_[False, hit, False].astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _search(source, keep_text: bool, clean: bool):
    def run(batches):
        p = source.value
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            for i, j in pieces(offsets, SHARD_BYTES):
                w, hit, owners = find(data, offsets, i, j, p)
                n = np.diff(w.first)
                spans, items, cleaned = [], [], []
                own = np.searchsorted(owners[:, 0], np.arange(j - i + 1))
                touched = np.add.reduceat(np.append(hit, False), np.minimum(w.first[:-1], len(hit))) if len(hit) else n
                olds, oldi = batch.column("spans").slice(i, j - i), batch.column("items").slice(i, j - i)
                for d in range(j - i):
                    a, b = int(w.first[d]), int(w.first[d + 1])
                    got = (n[d] > 0 and touched[d] > 0)
                    found = {p["ids"][k] for k in owners[own[d]:own[d + 1], 1].tolist()} - {None}
                    before = olds[d].as_py() or []
                    if got or before:
                        here = hit[a:b].copy()
                        for s in before:
                            here[s["first"]:s["last"]] = True
                        x, y = _spans(here)
                        base = int(w.bounds[d])
                        spans.append([{"first": int(f), "last": int(l), "from": int(w.starts[a + f]) - base, "to": int(w.ends[a + l - 1]) - base}
                                      for f, l in zip(x, y)])
                    else:
                        spans.append([])
                    items.append(sorted(found | set(oldi[d].as_py() or [])))
                    if clean:
                        cleaned.append(cut_spans(batch.column("text")[i + d].as_py(), spans[-1]))
                own_names = [c for c in batch.schema.names if c not in ("text", "spans", "items", "n_words")]
                cols = [*[batch.column(c).slice(i, j - i) for c in own_names], batch.column("text").slice(i, j - i) if keep_text else None,
                        pa.array(cleaned, pa.string()) if clean else None, pa.array(n, pa.int64()),
                        pa.array(spans, pa.list_(pa.struct([(c, pa.int32()) for c in ("first", "last", "from", "to")]))),
                        pa.array(items, pa.list_(pa.string()))]
                names = [*own_names, "text", "cleaned", "n_words", "spans", "items"]
                yield pa.RecordBatch.from_arrays([c for c in cols if c is not None], names=[m for m, c in zip(names, cols) if c is not None])
        tidy()
    return run


def cut_spans(text: str | None, spans: list[dict]) -> str | None:
    """The text without its spans and the white space after each; unchanged without
    spans."""
    if not text or not spans:
        return text
    raw, out, at = text.encode(), [], 0
    for s in spans:
        out.append(raw[at:s["from"]])
        at = s["to"]
        while at < len(raw) and raw[at:at + 1].isspace():
            at += 1
    out.append(raw[at:])
    return b"".join(out).decode("utf-8", "replace")


def _blocks(bench: DataFrame) -> list[DataFrame]:
    """The distinct items, in blocks whose texts and ids have ``BLOCK_BYTES`` / 2 at
    most, but where a bin alone has more."""
    bytes_of = F.octet_length("text") + F.coalesce(F.octet_length("id"), F.lit(0))
    items = settle(bench.filter(F.col("text").rlike(r"[0-9A-Za-z]|[^\x00-\x7F]")).distinct().withColumn("bytes", bytes_of.cast("long")))
    most = BLOCK_BYTES // 2
    bins = BINS * max(1, -(-int(items.agg(F.sum("bytes")).first()[0] or 0) // most))
    # Bins are dealt by id and text, so that equal texts spread.
    binned = items.withColumn("bin", F.pmod(F.xxhash64("id", "text"), F.lit(bins)))
    cuts, held = [0], 0
    for r in binned.groupBy("bin").agg(F.sum("bytes").alias("bytes")).orderBy("bin").collect():
        if held and held + r["bytes"] > most:
            cuts.append(r["bin"])
            held = 0
        held += r["bytes"]
    return [binned.filter((F.col("bin") >= a) & (F.col("bin") < b)).select("id", "text") for a, b in zip(cuts, [*cuts[1:], bins])]


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  clean: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, *carry, [cleaned,] n_words, spans, items) for every row of ``docs``.

    spans: merged hits, as word numbers [first, last) and byte offsets [from, to);
    items: ids (as strings, sorted) whose phrases occur; ``clean``: also the text
    without the spans.
    """
    spark = docs.sparkSession
    bench = benchmark.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).cast("string").alias("text"))
    blocks = _blocks(bench)
    carried = {c: f"carry_{k}" for k, c in enumerate(carry)}
    rows = docs.select(F.col(doc_id).alias("doc_id"), *[F.col(c).alias(a) for c, a in carried.items()], F.col(text).cast("string").alias("text"),
                       F.lit(None).cast(SPANS.split(" ", 1)[1]).alias("spans"), F.lit(None).cast("array<string>").alias("items"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name not in ("text", "spans", "items"))
    for k, block in enumerate(blocks):
        part = block.collect()
        compiled = phrases([r["text"] for r in part], [r["id"] for r in part], window) \
            or _no_phrases(window)
        last = k == len(blocks) - 1
        rows = rows.mapInArrow(_search(spark.sparkContext.broadcast(compiled), not last, clean and last),
                               kinds + ", " + "text string, " * (not last) + "cleaned string, " * (clean and last)
                               + f"n_words long, {SPANS}, items array<string>")
    return rows.select("doc_id", *[F.col(a).alias(c) for c, a in carried.items()],
                       *[c for c in rows.columns if c != "doc_id" and c not in carried.values()])


def _no_phrases(window: int) -> dict:
    """Phrases that match nothing."""
    return {"vocabulary": np.zeros(1, np.uint64), "table": np.ones((1, window), np.int64), "lengths": np.full(1, window),
            "shortest": 1 << 40, "ids": [None], "from": np.zeros(2, np.int64), "owners": np.zeros(0, np.int64)}
