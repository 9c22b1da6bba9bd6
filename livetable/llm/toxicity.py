"""Toxicity: gradient-boosted trees over dense features, isotonic calibration.

Features of a text: densities of a general insult lexicon and of a lexicon learned from
the labels, hits near second-person words, shares of capitals, punctuation and digits,
and the rate of disguised words (signs or digits inside a word).  Nothing but the text
enters a score.

Learning uses at most ``MAX_ROWS`` labelled documents (those whose id hashes lowest; all
of them where there are fewer).  Three of four of these give the lexicon and the trees
(the lexicon's own rows are split in two, each half's features use the lexicon of the
other half, so the trees see hits as unseen texts have them); the last quarter fits the
isotonic calibration.  A lexicon entry is a word or a word's first 4 to 6 bytes that
many more toxic than other documents hold.

Scoring is one pass over the documents.  Null and empty texts have all features 0 and
are scored like any other.  Labels that are null are left out; of several labels of one
doc_id the largest counts.  Without both classes among the labels every score is the
share of label 1.  Repeated rows are scored one by one.  An empty table gives no rows.  Long texts
are read whole, in pieces of whole documents.  Ties of the hash are broken by doc_id.  Training
rows are dealt and ordered by their content, so scores do not depend on files.  Carried columns
keep their values, whatever their names; others are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, functions as F

from .spans import ALNUM, LOWER, Words, column_bytes, hash_spans, pieces
from .store import settle

MAX_ROWS = 20_000       # labelled documents learned from
MAX_LEXICON = 4_000     # learned entries
PREFIXES = (4, 5, 6)
NEAR = 5                # words around a hit in which a second person counts
TREES, DEPTH = 15, 3
PARTS = 8               # partitions of the learned rows
PIECE = 1 << 20         # bytes of text whose running counts are held at once

#: General insults (fixed value).
INSULTS = ("idiot moron stupid dumb fool loser clown trash scum garbage worthless pathetic disgusting "
           "ugly filthy vermin imbecile jerk creep liar coward bastard bitch asshole shit fuck crap "
           "idiota imbécil estúpido basura inútil idiote stupide imbécile ordure dummkopf trottel arschloch "
           "abschaum scheiße").split()
#: Second-person words of English, German, French and Spanish (fixed value).
SECOND = ("you your yours yourself u ur du dich dir dein deine ihr euch euer tu toi te ton ta tes vous votre vos "
          "tú usted ustedes vosotros ti contigo").split()

FEATURES = ("insults", "learned", "learned_weight", "learned_count", "strongest", "near_you", "second", "capitals",
            "exclaims", "punctuation", "digits", "disguised", "repeats", "length")


def _hash_words(words: list[str]) -> np.ndarray:
    data, offsets = column_bytes(pa.array(words, pa.string()))
    w = Words(data, offsets, 0, len(words), LOWER, ALNUM)
    return np.unique(w.hashes())


def _member(x: np.ndarray, sorted_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_):
        return np.zeros(len(x), bool), np.zeros(len(x), np.int64)
    at = np.minimum(np.searchsorted(sorted_, x), len(sorted_) - 1)
    return sorted_[at] == x, at


def entries(w: Words) -> list[np.ndarray]:
    """Keys of each word: the whole word, then its prefixes (0 where it is shorter)."""
    size = w.ends - w.starts
    out = [w.hashes()]
    for n in PREFIXES:
        key = hash_spans(w.buf, w.starts, np.minimum(size, n), seed=1000 + n)
        key[size < n] = 0
        out.append(key)
    return out


_CAPITAL = np.zeros(256, bool)
_CAPITAL[0x41:0x5B] = True
_LETTER = _CAPITAL.copy()
_LETTER[0x61:0x7B] = _LETTER[0x80:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_SIGN = np.zeros(256, bool)
_SIGN[0x21:0x30] = _SIGN[0x3A:0x41] = _SIGN[0x5B:0x61] = _SIGN[0x7B:0x7F] = True
_INNER = _SIGN | _DIGIT
_INNER[[0x27, 0x2D]] = False     # apostrophes and hyphens stand in ordinary words


def features(data: np.ndarray, offsets: np.ndarray, i: int, j: int, keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """(documents, features) of the documents i..j of a column."""
    w = Words(data, offsets, i, j, LOWER, ALNUM)
    raw = data[offsets[i]:offsets[j]]
    n_docs, n = j - i, np.diff(w.first).astype(float)
    doc = w.doc_of()
    best = np.zeros(len(w))
    for key in entries(w):
        ok, at = _member(key, keys)
        best = np.maximum(best, np.where(ok, weights[at] if len(weights) else 0.0, 0.0))
    learned = best > 0
    insult = _member(w.hashes(), _hash_words(INSULTS))[0]
    second = _member(w.hashes(), _hash_words(SECOND))[0]
    # Second-person words within NEAR words of each word, inside its document.
    before = np.concatenate([[0], np.cumsum(second)])
    k = np.arange(len(w))
    lo, hi = np.maximum(k - NEAR, w.first[doc]), np.minimum(k + NEAR + 1, w.first[doc + 1])
    near = (learned | insult) & (before[hi] - before[lo] > 0)

    def per_word(x: np.ndarray) -> np.ndarray:
        return np.bincount(doc, weights=x, minlength=n_docs)[:n_docs]

    cum = {name: np.concatenate([[0], np.cumsum(table[raw])]) for name, table in
           (("capital", _CAPITAL), ("letter", _LETTER), ("digit", _DIGIT), ("sign", _SIGN))}
    excl = np.concatenate([[0], np.cumsum((raw == 0x21) | (raw == 0x3F))])
    same = np.zeros(len(raw), bool)
    same[1:] = (raw[1:] == raw[:-1]) & _SIGN[raw[1:]]
    b = w.bounds
    # Neither looks across the end of a document at its neighbour in the batch.
    first, last = b[b < len(raw)], b[b > 0] - 1
    same[first] = False
    reps = np.concatenate([[0], np.cumsum(same)])

    def share(c: np.ndarray, of: np.ndarray) -> np.ndarray:
        return (c[b[1:]] - c[b[:-1]]) / np.maximum(of, 1)
    size = np.diff(b).astype(float)
    # Disguised: a sign or digit between two letters of one blank-separated word.
    inner = np.zeros(len(raw), bool)
    if len(raw) > 2:
        inner[1:-1] = _INNER[raw[1:-1]] & _LETTER[raw[:-2]] & _LETTER[raw[2:]]
        inner[first] = inner[last] = False
    hide = np.concatenate([[0], np.cumsum(inner)])
    letters = cum["letter"][b[1:]] - cum["letter"][b[:-1]]
    words = np.maximum(n, 1)
    strongest = np.zeros(n_docs)
    np.maximum.at(strongest, doc, best)
    return np.stack([
        per_word(insult) / words, per_word(learned) / words, per_word(best) / words, np.log1p(per_word(learned | insult)),
        strongest, per_word(near) / words, per_word(second) / words, share(cum["capital"], letters), share(excl, words),
        share(cum["sign"], size), share(cum["digit"], size), share(hide, words), share(reps, size), np.log1p(n)], axis=1)


def _featurize(source):
    def run(batches):
        lexicons = source.value
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            which = batch.column("lexicon").to_numpy(zero_copy_only=False)
            for i, j in pieces(offsets, PIECE):
                x = np.zeros((j - i, len(FEATURES)))
                for l in np.unique(which[i:j]).tolist():
                    rows = which[i:j] == l
                    x[rows] = features(data, offsets, i, j, *lexicons[l])[rows]
                cols = [pa.ListArray.from_arrays(np.arange(0, x.size + 1, len(FEATURES), dtype=np.int32), pa.array(x.ravel()))
                        if c == "text" else batch.column(c).slice(i, j - i) for c in batch.schema.names if c != "lexicon"]
                yield pa.RecordBatch.from_arrays(cols, names=["x" if c == "text" else c for c in batch.schema.names if c != "lexicon"])
    return run


def _presence(batches):
    """Documents of each class and half that hold each entry, counted within a batch."""
    for batch in batches:
        data, offsets = column_bytes(batch.column("text"))
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
        half = batch.column("half").to_numpy(zero_copy_only=False)
        for i, j in pieces(offsets):
            w = Words(data, offsets, i, j, LOWER, ALNUM)
            doc = w.doc_of()
            for key in entries(w):
                keep = key != 0
                if not keep.any():
                    continue
                key, d = key[keep], doc[keep]
                o = np.lexsort((d, key))
                key, d = key[o], d[o]
                new = np.r_[True, (key[1:] != key[:-1]) | (d[1:] != d[:-1])]
                key, d = key[new], d[new] + i
                cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
                cols = [key[cut].view(np.int64)]
                for h in (0, 1):
                    in_half = half[d] == h
                    cols += [np.add.reduceat(in_half * toxic[d], cut), np.add.reduceat(in_half.astype(np.int64), cut)]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names=["entry", "b0", "n0", "b1", "n1"])


def _lexicon(counts: DataFrame, bad: str, n: str, toxic: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries held by more toxic documents than chance gives (smoothed log odds above
    three standard errors); weight: the log odds."""
    counts = counts.select("entry", F.expr(bad).alias("bad"), F.expr(n).alias("n"))
    odds = F.log((F.col("bad") + 0.5) / (toxic + 1)) - F.log((F.col("n") - F.col("bad") + 0.5) / (rows - toxic + 1))
    error = F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("n") - F.col("bad") + 0.5))
    best = counts.filter("bad >= 3").withColumn("odds", odds).filter(F.col("odds") > 3 * error) \
        .orderBy(F.desc(F.col("odds") * F.sqrt("bad")), "entry").limit(MAX_LEXICON).select("entry", "odds").toPandas()
    keys = best["entry"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], best["odds"].to_numpy(float)[order]


class Model:
    """A fitted scorer: ``score(docs)`` gives (*columns, score, predicted)."""

    def __init__(self, lexicon, trees, calibration, prior: float):
        self.lexicon, self.trees, self.calibration, self.prior = lexicon, trees, calibration, prior

    def score(self, docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
        """(*carry, score, predicted) for every row of ``docs``."""
        names = {c: f"carry_{k}" for k, c in enumerate(carry)}
        rows = docs.select(*[F.col(c).alias(a) for c, a in names.items()], F.col(text).cast("string").alias("text"))
        back = [F.col(a).alias(c) for c, a in names.items()]
        if self.trees is None:
            score = F.lit(self.prior)
            return rows.select(*back, score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))
        spark = docs.sparkSession
        source = spark.sparkContext.broadcast({0: self.lexicon})
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
        x = rows.select(*names.values(), "text", F.lit(0).alias("lexicon")) \
            .mapInArrow(_featurize(source), f"{kinds}, x array<double>")
        out = self.calibration.transform(_margin(self.trees, x))
        score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("calibrated")))
        return out.select(*back, score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


def _margin(trees, x: DataFrame) -> DataFrame:
    return trees.transform(x.withColumn("features", array_to_vector("x"))) \
        .withColumn("margin", vector_to_array("rawPrediction")[1])


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, label: str = "toxic") -> Model:
    """Learn from the labelled rows of ``docs`` for which ``allowed`` (over doc_id) holds."""
    spark = docs.sparkSession
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("toxic")) \
        .dropna().filter(allowed).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # Bounded, so it may be broadcast: MAX_ROWS rows of three numbers.
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_ROWS) \
        .withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(4)).cast("long"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .join(F.broadcast(chosen), "doc_id").select("text", "toxic", "half")
    # A bounded table, dealt and ordered by its rows, so that nothing depends on files and arrival.
    key = F.xxhash64("text")
    rows = settle(rows.repartitionById(PARTS, F.pmod(key, F.lit(PARTS)).cast("int")).sortWithinPartitions(key, "half", "toxic"))
    # Quarters 0 and 1: lexicon and trees crosswise; 2: both with the lexicon of 0 and 1; 3: calibration.
    sizes = {(r["half"], r["toxic"]): r["count"] for r in rows.groupBy("half", "toxic").count().collect()}
    total = lambda halves, t=(0, 1): sum(sizes.get((h, y), 0) for h in halves for y in t)
    prior = total(range(4), (1,)) / max(1, total(range(4)))
    counts = settle(rows.filter("half < 2").mapInArrow(_presence, "entry long, b0 long, n0 long, b1 long, n1 long")
                    .groupBy("entry").agg(*[F.sum(c).alias(c) for c in ("b0", "n0", "b1", "n1")]).filter("b0 + b1 >= 3"))
    lexicons = {0: _lexicon(counts, "b0 + b1", "n0 + n1", total((0, 1), (1,)), total((0, 1))),
                1: _lexicon(counts, "b1", "n1", total((1,), (1,)), total((1,))),
                2: _lexicon(counts, "b0", "n0", total((0,), (1,)), total((0,)))}
    source = spark.sparkContext.broadcast(lexicons)
    lexicon = F.when(F.col("half") == 0, 1).when(F.col("half") == 1, 2).otherwise(0)
    x = settle(rows.select("toxic", "half", "text", lexicon.alias("lexicon"))
               .mapInArrow(_featurize(source), "toxic int, half long, x array<double>"))
    train, held = x.filter("half < 3"), x.filter("half = 3")
    if not total((0, 1, 2), (0,)) or not total((0, 1, 2), (1,)):
        return Model(lexicons[0], None, None, prior)
    trees = GBTClassifier(labelCol="label", featuresCol="features", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=11,
                          minInstancesPerNode=2) \
        .fit(train.select(array_to_vector("x").alias("features"), F.col("toxic").cast("double").alias("label")))
    by = held if total((3,), (0,)) and total((3,), (1,)) else x
    calibration = IsotonicRegression(labelCol="toxic", featuresCol="margin", predictionCol="calibrated") \
        .fit(_margin(trees, by).select("margin", F.col("toxic").cast("double").alias("toxic")))
    return Model(lexicons[0], trees, calibration, prior)
