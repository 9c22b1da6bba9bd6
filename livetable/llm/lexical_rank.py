"""Ranked lexical search by dense blocked matrix products.

Every item is a query against every document.  Terms are the runs of letters, digits and
non-ASCII characters of the whole text, A-Z lower-cased.  With N documents that have a term,
L terms in all and n in a document, a term in df documents weighs
``w = floor(1000 ln((2N + 2) / (2 df + 1)))``, a document's length counts as
``m = 50 + (50 n N) div L``, a term that occurs tf times has the impact
``(10^9 tf) div (1000 tf + 20 m)``, and a document's score is the sum of w times impact over
the item's terms: whole numbers throughout.

1. The items' distinct terms, by 64-bit hash, are the vocabulary, numbered in order.
2. One pass over the documents keeps of each tile (at most ``TILE_DOCS`` documents, about 4 MB
   of text) the postings of the vocabulary: document, term and count as packed arrays in one
   cell, written to the shared folder.  df, N and L are summed from the tiles by Spark.
3. Each task multiplies its tiles: a block of at most ``BLOCK_ITEMS`` items has a compact
   vocabulary; slices of it give a weight tile (items x terms) and an impact tile
   (terms x documents), both dense float64, multiplied by BLAS.  A slice has so few terms
   that no partial sum reaches 2^53, so every product is exact; slices add up in 64-bit integers.
4. A task keeps the best k documents of each item over all its tiles (score, then smaller
   doc_id, so a tie at the edge never depends on the tile) and emits them once; Spark
   ranks what the tasks send, at most k rows for each item and task.

Items are taken in groups of about ``PAIRS`` (item, term) pairs, so that what is collected and
broadcast, 8 bytes a pair for the vocabulary and 8 for the weights, has a bound whatever the
number of items; each group is a job of its own with one Python stage.  An item is the
smallest unit of a group.

Null and empty texts have no terms: such documents do not count in N and such items have no
rows.  Each row of ``documents`` is a document; a repeated row is ranked as often as it
stands there.  A null doc_id ranks behind equal scores.  Rows of ``items`` with the same
item_id (or none) are one item with all their terms.  Texts of any length are read whole; a
long document is a tile of its own.  Empty tables give no rows.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from livetable.session import shared_dir

from .packed import pack, unpack
from .spans import ALNUM, LOWER, Words, column_bytes, pieces

TILE_DOCS, BLOCK_ITEMS, BLOCK_TERMS = 1024, 256, 2048
PAIRS = 2 << 20
EXACT = 1 << 53


def _term_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, offsets = column_bytes(b.column("text"))
        for i, j in pieces(offsets):
            w = Words(data, offsets, i, j, LOWER, ALNUM)
            h = w.hashes().view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(w.first, pa.int32()), pa.array(h))
            yield pa.RecordBatch.from_arrays([b.column("item_id").slice(i, j - i), lists], ["item_id", "terms"])


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (item_id, term hash)."""
    rows = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_term_lists, "item_id long, terms array<long>") \
        .select("item_id", F.explode("terms").alias("term")).distinct()


def _postings(vocabulary) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary.value
        for b in batches:
            data, offsets = column_bytes(b.column("text"))
            ids = b.column("doc_id")
            null = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            for lo, hi in pieces(offsets):
                for i in range(lo, hi, TILE_DOCS):
                    yield _tile(Words(data, offsets, i, min(i + TILE_DOCS, hi), LOWER, ALNUM), words,
                                ids[i:min(i + TILE_DOCS, hi)], null[i:min(i + TILE_DOCS, hi)])
    return run


_TILE = pa.schema([("n_docs", pa.int64()), ("n_terms", pa.int64()), ("terms", pa.list_(pa.int32())),
                   ("docs", pa.list_(pa.int32())), ("cell", pa.binary())])
_TILE_SQL = "n_docs long, n_terms long, terms array<int>, docs array<int>, cell binary"


def _tile(w: Words, vocabulary: np.ndarray, ids: np.ndarray, null: np.ndarray) -> pa.RecordBatch:
    counts = w.counts
    h = w.hashes().view(np.int64)
    at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
    known = vocabulary[at] == h
    key, tf = np.unique(w.doc_of()[known] * len(vocabulary) + at[known], return_counts=True)
    doc, term = key // len(vocabulary), key % len(vocabulary)
    seen, df = np.unique(term, return_counts=True)
    has = np.unique(doc)   # only documents with a term of the vocabulary are carried
    cell = pack(ids[has], null[has].astype(np.uint8), counts[has].astype(np.int64), np.searchsorted(has, doc).astype(np.int32),
                term.astype(np.int32), tf.astype(np.int32))
    return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(
        (int((counts > 0).sum()), int(counts.sum()), seen.astype(np.int32), df.astype(np.int32), cell), _TILE.types)], schema=_TILE)


def _weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """(10^9 tf) div (1000 tf + 20 m) for counts ``tf`` in documents of ``n`` terms."""
    if len(n) and 50 * int(n.max()) * n_docs >= 1 << 63:
        grown = np.array([50 * int(x) * n_docs // n_terms for x in n], np.int64)
    else:
        grown = 50 * n.astype(np.int64) * n_docs // max(n_terms, 1)
    tf = tf.astype(np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 20 * (50 + grown))


class _Best:
    """The best k (score, then smaller doc_id, null last) of each item so far."""

    def __init__(self, k: int):
        self.k = k
        self.item = self.score = self.doc = np.zeros(0, np.int64)
        self.null = np.zeros(0, np.uint8)

    def floor(self, items: int) -> np.ndarray:
        """The score below which a document cannot enter, for each item."""
        low, full = np.ones(items, np.int64), np.bincount(self.item, minlength=items) == self.k
        np.minimum.at(least := np.full(items, np.iinfo(np.int64).max), self.item, self.score)
        low[full] = least[full]
        return low

    def add(self, item, score, doc, null) -> None:
        item, score = np.r_[self.item, item], np.r_[self.score, score]
        doc, null = np.r_[self.doc, doc], np.r_[self.null, null]
        order = np.lexsort((doc, null, -score, item))
        first = np.searchsorted(item[order], item[order])
        order = order[np.arange(len(order)) - first < self.k]
        self.item, self.score, self.doc, self.null = item[order], score[order], doc[order], null[order]


def _blocks(item: np.ndarray, term: np.ndarray, items: int) -> list[tuple]:
    """(first item, items, compact vocabulary, item of each pair, its place in the vocabulary)."""
    out = []
    for a in range(0, items, BLOCK_ITEMS):
        lo, hi = np.searchsorted(item, [a, a + BLOCK_ITEMS])
        own, place = np.unique(term[lo:hi], return_inverse=True)
        out.append((a, min(BLOCK_ITEMS, items - a), own, item[lo:hi] - a, place))
    return out


def _scores(block: tuple, weight: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, docs: int) -> np.ndarray:
    """Exact scores (items x documents) of a block of items over one tile of documents."""
    _, items, own, row, place = block
    score = np.zeros((items, docs), np.int64)
    at = np.minimum(np.searchsorted(own, term), len(own) - 1)
    keep = own[at] == term
    at, doc, impact = at[keep], doc[keep], impact[keep]
    used = np.unique(at)                          # the terms that this tile has
    if not len(used):
        return score
    top = int(weight[own[used]].max()) * int(impact.max())
    wide = max(1, min(BLOCK_TERMS, (EXACT - 1) // max(top, 1)))
    slot = np.full(len(own), -1)
    slot[used] = np.arange(len(used))
    at, pair = slot[at], slot[place]
    for c in range(0, len(used), wide):
        n = min(wide, len(used) - c)
        w, d = np.zeros((items, n)), np.zeros((n, docs))
        p = (pair >= c) & (pair < c + n)
        w[row[p], pair[p] - c] = weight[own[place[p]]]
        p = (at >= c) & (at < c + n)
        d[at[p] - c, doc[p]] = impact[p]
        score += (w @ d).astype(np.int64)
    return score


def _rank(shared, n_docs: int, n_terms: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, known, item, term, weight = shared.value
        blocks, best = _blocks(item, term, len(ids)), None
        best = [_Best(k) for _ in blocks]
        for b in batches:
            for cell in b.column("cell"):
                doc_id, null, n, doc, t, tf = unpack(cell.as_py())
                if not len(doc):
                    continue
                impact = impacts(tf, n[doc], n_docs, n_terms)
                for block, top in zip(blocks, best):
                    score = _scores(block, weight, doc, t, impact, len(doc_id))
                    i, d = np.nonzero(score >= top.floor(block[1])[:, None])
                    if len(i):
                        top.add(i, score[i, d], doc_id[d], null[d])
        for block, top in zip(blocks, best):
            i = top.item + block[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[i], pa.int64(), mask=~known[i]), pa.array(top.doc, pa.int64(), mask=top.null == 1),
                 pa.array(top.score, pa.int64())], ["item_id", "doc_id", "score"])
    return run


def rank(docs: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", text: str = "text",
         item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` highest-scoring documents of each item,
    best first, with a score above 0; equal scores by ascending doc_id."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    root = shared_dir(spark, "lexical_rank", unique=True)
    item_terms(items, item_id, item_text).write.parquet(f"{root}/pairs")
    pairs = spark.read.parquet(f"{root}/pairs")
    groups = -(-pairs.count() // PAIRS)
    found = None
    for g in range(groups):
        part = _group(spark, rows, pairs.filter(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == g), k, f"{root}/{g}")
        found = part if found is None else found.union(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k) \
        .select("item_id", "rank", "doc_id", "score")


def _group(spark, rows: DataFrame, pairs: DataFrame, k: int, path: str) -> DataFrame:
    own = pairs.toArrow()
    ids = own["item_id"].combine_chunks()
    known = ~ids.is_null().to_numpy(zero_copy_only=False)
    ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
    vocabulary, term = np.unique(own["term"].to_numpy(), return_inverse=True)
    if not len(vocabulary):
        return spark.createDataFrame([], "item_id long, doc_id long, score long")
    rows.mapInArrow(_postings(spark.sparkContext.broadcast(vocabulary)), _TILE_SQL).write.parquet(path)
    tiles = spark.read.parquet(path)
    total = tiles.agg(F.sum("n_docs").alias("N"), F.sum("n_terms").alias("L")).first()
    n_docs, n_terms = total["N"] or 0, total["L"] or 0
    df = tiles.select(F.explode(F.arrays_zip("terms", "docs")).alias("x")).groupBy(F.col("x.terms").alias("term")) \
        .agg(F.sum("x.docs").alias("df")).toArrow()
    weight = np.zeros(len(vocabulary), np.int64)
    weight[df["term"].to_numpy()] = [_weight(n_docs, x) for x in df["df"].to_pylist()]
    # Items in order; a null id is an item too.
    order = np.lexsort((term, ids, known))
    ids, known, term = ids[order], known[order], term[order]
    new = np.r_[True, (ids[1:] != ids[:-1]) | (known[1:] != known[:-1])]
    shared = spark.sparkContext.broadcast((ids[new], known[new], np.cumsum(new) - 1, term.astype(np.int64), weight))
    return tiles.select("cell").mapInArrow(_rank(shared, n_docs, n_terms, k), "item_id long, doc_id long, score long")


SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM documents),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
lens AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tfs GROUP BY doc_id),
total AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM lens),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tfs, total GROUP BY term, nn),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nn) // ll)))) AS BIGINT) AS score
  FROM wanted JOIN tfs USING (term) JOIN weights USING (term) JOIN lens USING (doc_id), total GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50
"""
