"""Phrase collocations through mergeable Misra-Gries summaries.

Texts (A-Z lower-cased) are split at ``. , ; : ! ?`` and line breaks into pieces, pieces at
blanks and tabs into words.  Per language, a candidate is a phrase of ``sizes`` words that
occurs a >= ``min_count`` times within pieces.  Cut after its first k words, whose parts
occur l and r times, it scores floor(10^6 a^2 / (l r)); its lowest-scoring cut counts.

1. Summaries.  Documents are dealt to shards.  A shard counts its n-grams of 1 to the
   largest size and sends each hash partition the hashes and counts that fall there, sorted,
   as one packed cell of two or three bytes an n-gram; the cells are written to the shared folder.  A partition streams its
   cells and merges them into one Misra-Gries summary: where more than C counters are left,
   the (C + 1)-th largest count is taken off all.  With mass M, C > ``SLACK`` M / min_count, so
   what was taken off (E) is below min_count / SLACK and an n-gram of min_count occurrences
   keeps min_count - E at least: every frequent n-gram survives, and what is below that is
   infrequent.  A partition holds C counters of 8 bytes and never its data.
2. Replies.  The cells stream through their partitions again, behind the summary's survivors,
   and each shard is told which of the hashes that it sent survive.
3. Exact counts.  The shards go over their documents again and send the survivors, as
   text, with their counts, one row for each phrase and piece of a shard; Spark sums them.
   Equal hashes only let more phrases through; the counts are of texts.

Scores, covered candidates and ranks are Spark joins, aggregates and windows over the
frequent phrases, with decimals of 38 digits for products beyond 64 bits.  A phrase of a third
of all documents is one entry of each shard's cell and one row of each shard; a language of a
third of all candidates is ranked in ``SALT`` parts first, of which each keeps ``top`` rows.

Within a shard n-grams are told apart by 64-bit hashes.  Counts up to 10^15 are exact.

A null text is empty; empty texts have no words.  A null language is ``und``, together with
rows that say so.  Each row is a document; repeated rows count again.  Equal scores and counts
are ranked by the phrase's bytes, and no two phrases of a language are equal.  A document is
the smallest unit of a shard, read whole in pieces of 1 MB or, if longer, by itself.  Empty
tables give no rows.  Other columns are ignored, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from livetable.session import shared_dir

from .packed import by_target
from .spans import LOWER, Words, column_bytes, gram_hashes, inside, mix, pieces, tidy
from .store import shard_count

SHARD_BYTES, WIDE_SHARD_BYTES, MANY_SHARDS = 16 << 20, 64 << 20, 4096
PIECE_BYTES = 1 << 20
COUNTERS = 8 << 20
SLACK = 2
SPARSE = 4          # hash values of a partition for each n-gram it may get
CELL_GRAMS = 1 << 19
SALT = 64

_BREAK = np.zeros(256, dtype=bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_WORD = ~_BREAK
_WORD[[0x20, 0x09]] = False

_CELL = pa.schema([("target", pa.int32()), ("shard", pa.int32()), ("mass", pa.int64()), ("cell", pa.binary()), ("times", pa.binary())])
_CELL_SQL = "target int, shard int, mass long, cell binary, times binary"
_COUNT = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())])
_COUNT_SQL = "lang string, size int, phrase string, n long"


class _Grams:
    """The n-grams of some documents that share a language set.

    ``start[n]``: first word of each n-gram within one piece; ``key[n]``: its 64-bit
    hash with the language."""

    def __init__(self, data, offsets, i, j, lang: np.ndarray, salts: np.ndarray, largest: int):
        self.words = w = Words(data, offsets, i, j, LOWER, _WORD)
        self.lang = lang[i:j][w.doc_of()]            # of each word
        h = w.hashes()
        breaks = np.cumsum(_BREAK[w.buf], dtype=np.int32)[w.starts] if len(w) else np.zeros(0, np.int32)
        self.start, self.key = {}, {}
        for n in range(1, largest + 1):
            s = inside(w.first, n)
            s = s[breaks[s] == breaks[s + n - 1]]
            self.start[n] = s
            self.key[n] = mix(gram_hashes(h, n)[s] ^ salts[self.lang[s]])

    def phrases(self, first: np.ndarray, size: np.ndarray) -> pa.Array:
        """Texts of the n-grams of ``size`` words from word ``first``, one blank between words."""
        w = self.words
        # The words one after the other, each with one byte behind it ...
        lens = w.ends - w.starts + 1
        at = np.concatenate([[0], np.cumsum(lens)])
        line = w.buf[np.repeat(w.starts - at[:-1], lens) + np.arange(at[-1])]
        line[at[1:] - 1] = 0x20
        # ... and the stretches asked for.
        begin, ends = at[first], at[first + size] - 1
        offsets = np.concatenate([[0], np.cumsum(ends - begin)])
        out = line[np.repeat(begin - offsets[:-1], ends - begin) + np.arange(offsets[-1])]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [
            None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(out.tobytes())]).cast(pa.large_string()).cast(pa.string())


def _each(table: pa.Table, largest: int) -> Iterator[tuple[list[str], _Grams]]:
    langs = table["lang"].combine_chunks().dictionary_encode()
    if isinstance(langs, pa.ChunkedArray):
        langs = langs.combine_chunks()
    names = langs.dictionary.to_pylist()
    salts = mix(np.frombuffer(b"".join(np.uint64(_name_hash(x)).tobytes() for x in names), np.uint64)) if names else np.zeros(0, np.uint64)
    lang = langs.indices.to_numpy(zero_copy_only=False)
    data, offsets = column_bytes(table["text"])
    for i, j in pieces(offsets, PIECE_BYTES):
        yield names, _Grams(data, offsets, i, j, lang, salts, largest)


def _name_hash(name: str) -> int:
    out = 0xCBF29CE484222325
    for byte in name.encode():
        out = (out ^ byte) * 0x100000001B3 & (1 << 64) - 1
    return out


def _place(key: np.ndarray, targets: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash partition of a key, and the key within it (its lowest bits: few, so that the
    steps between sorted keys of a cell are small numbers)."""
    return ((key >> np.uint64(32)) % np.uint64(targets)).astype(np.int64), (key & np.uint64((1 << bits) - 1)).astype(np.uint32)


def _summed(key: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return key[cut], np.add.reduceat(count, cut) if len(cut) else count


def squeeze(x: np.ndarray) -> bytes:
    """Numbers in 7 bits a byte, lowest first; the high bit says that more follow."""
    x = x.astype(np.uint64)
    n = 1 + sum((x >= np.uint64(1 << 7 * k)).astype(np.int64) for k in range(1, 5))
    at = np.cumsum(n) - n
    out = np.zeros(int(n.sum()), np.uint8)
    for k in range(5):
        live = n > k
        out[at[live] + k] = (x[live] >> np.uint64(7 * k) & np.uint64(127)) | np.where(n[live] > k + 1, 128, 0).astype(np.uint64)
    return out.tobytes()


def expand(raw: bytes) -> np.ndarray:
    b = np.frombuffer(raw, np.uint8)
    last = np.flatnonzero(b < 128)
    first = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
    place = np.arange(len(b)) - np.repeat(first, last - first + 1)
    part = (b & 127).astype(np.uint64) << (7 * place).astype(np.uint64)
    return np.add.reduceat(part, first) if len(first) else part


def _steps(key: np.ndarray) -> bytes:
    return squeeze(np.diff(key, prepend=np.uint32(0)))


def _keys(raw: bytes) -> np.ndarray:
    """What ``_steps`` packed."""
    return np.cumsum(expand(raw)).astype(np.uint32)


def _cells(shard: int, parts: list[tuple[np.ndarray, np.ndarray]], targets: int) -> Iterator[tuple]:
    """One packed cell for each hash partition, from the sorted places and counts of a shard's
    pieces.  ``CELL_GRAMS`` n-grams of all pieces are merged at a time, never the whole shard."""
    slices = min(targets, 1 + sum(len(place) for place, _ in parts) // CELL_GRAMS)
    edges = [np.uint64(targets * k // slices << 32) for k in range(slices + 1)]
    cuts = [np.searchsorted(place, edges) for place, _ in parts]
    for k in range(slices):
        place, count = _summed(np.concatenate([p[c[k]:c[k + 1]] for (p, _), c in zip(parts, cuts)]),
                               np.concatenate([n[c[k]:c[k + 1]] for (_, n), c in zip(parts, cuts)]).astype(np.int64))
        for t, (low, n) in by_target((place >> np.uint64(32)).astype(np.int64), place.astype(np.uint32), count):
            yield t, shard, int(n.sum()), _steps(low), squeeze(n)


def _send(targets: int, bits: int, largest: int):
    def run(table: pa.Table) -> pa.Table:
        parts = []
        for _, g in _each(table, largest):
            target, low = _place(np.concatenate(list(g.key.values())), targets, bits)
            place, count = np.unique(target.astype(np.uint64) << np.uint64(32) | low, return_counts=True)
            parts.append((place, count.astype(np.uint32)))
            del g, target, low, count
        rows = list(_cells(table["shard"][0].as_py(), parts, targets)) if parts else []
        del parts
        tidy()
        return pa.Table.from_batches([_batch(rows)], schema=_CELL)
    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(_CELL.types)], schema=_CELL)


class Summary:
    """A Misra-Gries summary that others (or exact counts) merge into.

    With ``capacity`` counters and total mass M, ``taken`` <= M / (capacity + 1), and a key's
    true count lies between its counter and its counter + ``taken``."""

    def __init__(self, capacity: int):
        self.capacity, self.taken = capacity, 0
        self.key, self.count = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self._wait, self._waiting = [], 0

    def add(self, key: np.ndarray, count: np.ndarray) -> None:
        self._wait.append((key, count.astype(np.int64)))
        self._waiting += len(key)
        if self._waiting >= self.capacity:
            self.settle()

    def settle(self) -> None:
        self.key, self.count = _summed(np.concatenate([self.key, *(k for k, _ in self._wait)]),
                                       np.concatenate([self.count, *(c for _, c in self._wait)]))
        self._wait, self._waiting = [], 0
        over = len(self.key) - self.capacity
        if over > 0:
            least = int(np.partition(self.count, over - 1)[over - 1])
            self.count -= least
            self.taken += least
            left = self.count > 0
            self.key, self.count = self.key[left], self.count[left]

    def survivors(self, min_count: int) -> np.ndarray:
        """Every key whose true count may be ``min_count`` or more, in order."""
        self.settle()
        return self.key[self.count + self.taken >= min_count]


def _summaries(min_count: int):
    """Cells in order of the target, each with its target's ``total`` mass -> survivors."""
    def done(target: int, summary: Summary) -> pa.RecordBatch:
        return _batch([(target, -1, 0, _steps(summary.survivors(min_count)), None)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, summary = None, None
        for b in batches:
            for target, total, cell, times in zip(b.column("target").to_pylist(), b.column("total").to_pylist(), b.column("cell"), b.column("times")):
                if target != at:
                    if summary is not None:
                        yield done(at, summary)
                    at, summary = target, Summary(SLACK * total // min_count + 1)
                summary.add(_keys(cell.as_py()), expand(times.as_py()))
        if summary is not None:
            yield done(at, summary)
        tidy()
    return run


def _replies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Behind each target's survivors (shard -1) its cells -> to each shard what survives."""
    at, known = None, None
    for b in batches:
        rows = []
        for target, shard, cell in zip(b.column("target").to_pylist(), b.column("shard").to_pylist(), b.column("cell")):
            if shard == -1:
                at, known = target, _keys(cell.as_py())
                continue
            if target != at:
                raise RuntimeError(f"no summary before the cells of hash partition {target}")
            key = _keys(cell.as_py())
            key = np.unique(key[_isin(key, known)])
            if len(key):
                rows.append((target, shard, 0, _steps(key), None))
        yield _batch(rows)
    tidy()


def _isin(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(x), bool)
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


def _count(targets: int, bits: int, largest: int):
    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        known = [np.zeros(0, np.uint64)]
        for target, cell in zip(replies["target"].to_pylist(), replies["cell"]):
            known.append(_keys(cell.as_py()).astype(np.uint64) | np.uint64(target) << np.uint64(32))
        known, out = np.unique(np.concatenate(known)), []
        if not len(docs):
            return _COUNT.empty_table()
        for names, g in _each(docs, largest):
            total = np.bincount(g.lang, minlength=len(names))
            out.append(pa.table([names, [0] * len(names), [""] * len(names), total.tolist()], schema=_COUNT))
            for n in range(1, largest + 1):
                target, low = _place(g.key[n], targets, bits)
                kept = np.flatnonzero(_isin(low.astype(np.uint64) | target.astype(np.uint64) << np.uint64(32), known))
                _, first, count = np.unique(g.key[n][kept], return_index=True, return_counts=True)
                first = g.start[n][kept[first]]
                lang = pa.DictionaryArray.from_arrays(pa.array(g.lang[first], pa.int32()), pa.array(names, pa.string())).cast(pa.string())
                out.append(pa.table([lang, pa.array(np.full(len(first), n), pa.int32()),
                                     g.phrases(first, np.full(len(first), n)), pa.array(count, pa.int64())], schema=_COUNT))
        tidy()
        return pa.concat_tables(out)
    return run


def frequent_phrases(docs: DataFrame, largest: int, min_count: int, lang: str = "lang", text: str = "text",
                     doc_id: str | None = "doc_id") -> DataFrame:
    """(lang, size, phrase, n): every phrase of 1 to ``largest`` words with ``min_count``
    occurrences or more in its language and their exact number, and a row of size 0 with the
    words of each language.  ``doc_id`` only deals equal texts to different shards."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                       F.col(text).cast("string").alias("text"), *([F.col(doc_id).alias("doc_id")] if doc_id else []))
    small = shard_count(rows, "text", SHARD_BYTES)
    shards = min(small, max(MANY_SHARDS, small * SHARD_BYTES // WIDE_SHARD_BYTES))
    # A text of b bytes has at most (b + 1) / 2 words: a bound of the mass, which is only counted later.
    mass = small * SHARD_BYTES // 2 * largest
    targets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-mass * SLACK // (min_count * COUNTERS)))
    bits = min(32, max(16, (mass * SPARSE // targets).bit_length()))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64(*rows.columns), F.lit(shards)).cast("int")) \
        .select("lang", "text", "shard").repartition(shards, "shard")
    root = shared_dir(spark, "collocations", unique=True)
    rows.groupBy("shard").applyInArrow(_send(targets, bits, largest), _CELL_SQL).write.parquet(f"{root}/cells")
    cells = spark.read.parquet(f"{root}/cells")
    total = F.sum("mass").over(Window.partitionBy("target"))
    survivors = cells.repartitionById(targets, F.col("target")).select("target", "cell", "times", total.alias("total")) \
        .mapInArrow(_summaries(min_count), _CELL_SQL)
    sent = cells.select("target", "shard", "mass", "cell", F.lit(None).cast("binary").alias("times"))
    replies = survivors.union(sent).repartitionById(targets, F.col("target")).sortWithinPartitions("target", "shard") \
        .mapInArrow(_replies, _CELL_SQL)
    counts = rows.groupBy("shard").cogroup(replies.groupBy("shard")).applyInArrow(_count(targets, bits, largest), _COUNT_SQL)
    counts.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n")) \
        .filter((F.col("n") >= min_count) | (F.col("size") == 0)).write.parquet(f"{root}/frequent")
    return spark.read.parquet(f"{root}/frequent")


def _joined(words: Column, first, n) -> Column:
    return F.array_join(F.slice(words, first, n), " ")


def collocations(docs: DataFrame, sizes: tuple[int, int] = (2, 3), min_count: int = 10, cover: int = 50, top: int = 2000,
                 lang: str = "lang", text: str = "text", doc_id: str | None = "doc_id") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases by score, a and phrase.

    A candidate inside a longer one that occurs at least ``cover`` percent as often is left out.
    n: words of the language."""
    least, largest = sizes
    frequent = frequent_phrases(docs, largest, min_count, lang, text, doc_id)
    words = frequent.filter("size = 0").select("lang", "n")
    found = frequent.filter("size > 0").select("lang", "phrase", "size", F.col("n").alias("a"))
    candidates = found.filter(F.col("size") >= least).withColumn("words", F.split("phrase", " "))

    cuts = F.transform(F.sequence(F.lit(1), F.col("size") - 1), lambda k: F.struct(
        k.alias("k"), _joined(F.col("words"), F.lit(1), k).alias("left"), _joined(F.col("words"), k + 1, F.col("size") - k).alias("right")))
    part = found.select("lang", F.col("phrase").alias("part"), F.col("a").alias("n"))
    cut = candidates.select("lang", "phrase", "a", F.explode(cuts).alias("cut")).select("lang", "phrase", "a", "cut.*")
    cut = cut.join(part.select("lang", F.col("part").alias("left"), F.col("n").alias("l")), ["lang", "left"]) \
        .join(part.select("lang", F.col("part").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    wide = {c: F.col(c).cast("decimal(15,0)") for c in ("a", "l", "r")}
    cut = cut.withColumn("up", wide["a"] * wide["a"] * F.lit(1_000_000).cast("decimal(7,0)")) \
        .withColumn("down", wide["l"] * wide["r"]).withColumn("score", F.expr("up div down"))
    scored = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))

    inner = F.flatten(F.transform(F.sequence(F.lit(least), F.col("size") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("size") - m + 1), lambda s: _joined(F.col("words"), s, m))))
    covers = candidates.filter(F.col("size") > least).select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "a") \
        .groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = scored.join(covers, ["lang", "phrase"], "left").filter(f"longer is null or 100 * longer < {cover} * a") \
        .select("lang", "phrase", "a", "best.score", "best.l", "best.r")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALT))).orderBy(*order)
    left = left.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= top).drop("rank")
    left = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")) \
        .filter(F.col("rank") <= top)
    return left.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs),
split AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM split GROUP BY lang),
grams AS (
  SELECT lang, 1 AS size, unnest(w) AS phrase FROM split
  UNION ALL
  SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM split
  UNION ALL
  SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM split),
f AS (SELECT lang, size, phrase, count(*) AS a, string_split(phrase, ' ') AS w FROM grams GROUP BY lang, size, phrase HAVING count(*) >= 10),
cuts AS (
  SELECT lang, phrase, size, a, 1 AS k, w[1] AS lp, array_to_string(w[2:], ' ') AS rp FROM f WHERE size >= 2
  UNION ALL
  SELECT lang, phrase, size, a, 2, w[1] || ' ' || w[2], w[3] FROM f WHERE size = 3),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.a AS l, y.a AS r,
         CAST((CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = lp JOIN f y ON y.lang = c.lang AND y.phrase = rp),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
covers AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM f WHERE size = 3
    UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM f WHERE size = 3) GROUP BY lang, phrase),
kept AS (SELECT s.* FROM lowest s LEFT JOIN covers v ON s.lang = v.lang AND s.phrase = v.phrase WHERE longer IS NULL OR 100 * longer < 50 * s.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""
