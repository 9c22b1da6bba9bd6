"""Line dedup with levelled sorted runs of line hashes.

A line's key is the line without white space at both ends, A-Z lower-cased.  Keys of
at least ``min_chars`` code points that stand in at least ``threshold`` documents lose
all their lines in every document.

``LineRuns`` keeps what was counted so far as runs: tables of (h, g, n), the two 64-bit
hashes of a key and the number of documents with it, bucketed and sorted by the hashes.

* A new batch of documents is reduced to its own (h, g, n), merge-anti-joined with the
  entries of the runs that reached the threshold (they are decided, so nothing of them
  needs to be counted, shuffled back or stored again), and added as a run of level 0.
* Every ``fan`` runs of a level are compacted into one run of the next level: counts of
  equal hashes are summed, entries that reach the threshold become decided.  Buckets of
  all runs are aligned, so a compaction or an anti-join shuffles no run.
* ``decided`` merges the runs that are left.

``repeated_lines`` is the reading side: the positions of decided lines, found by a
semi-join of line hashes, go back to their documents as one sorted array each, and the
text is put together from the slices between them (linear in the lines).

Everything is DataFrame expressions.  A line of a third of all documents is one entry per
map task when counted; where decided keys do not fit Spark's broadcast threshold, the
semi-join is a sort-merge join whose hot keys AQE splits.

Each row is a document.  Null and empty texts are one empty line, which has no key.
Repeated rows count as documents of their own and lose the same lines; a null doc_id
changes nothing.  Ties do not arise (a key is decided or not).  An empty table gives no
rows.  A text of any length is one row, walked line by line.  Columns of the input are
taken by name only, so others, whatever they are called, do not matter.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from livetable.session import shared_dir

from .store import remove

THRESHOLD, MIN_CHARS = 10, 1
FAN = 4
BATCHES = 8
WHITE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HASHES = ["h", "g"]


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """Trimmed and with A-Z lower-cased; ``lower`` is right, and faster, for ASCII alone."""
    t = F.btrim(line, F.lit(WHITE))
    return F.when(F.octet_length(t) == F.length(t), F.lower(t)).otherwise(F.translate(t, _UPPER, _LOWER))


def _hashed(key: str) -> list[Column]:
    return [F.xxhash64(key).alias("h"), F.xxhash64(F.lit(1), key).alias("g")]


def line_counts(docs: DataFrame, text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(h, g, n): the hashes of each line key and in how many rows of ``docs`` it stands."""
    keys = F.array_distinct(F.filter(F.transform(_lines(text), line_key), lambda k: F.length(k) >= min_chars))
    return docs.select(F.explode(keys).alias("key")).select(*_hashed("key")) \
        .groupBy(*_HASHES).agg(F.count(F.lit(1)).alias("n"))


class LineRuns:
    """Levelled sorted runs of line hashes in the cluster's shared folder."""

    def __init__(self, spark: SparkSession, threshold: int = THRESHOLD, fan: int = FAN, min_chars: int = MIN_CHARS):
        self.spark, self.threshold, self.fan, self.min_chars = spark, threshold, fan, min_chars
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.root = shared_dir(spark, "line_runs", unique=True)
        self.levels: list[list[str]] = []

    def add(self, batch: DataFrame, text: str = "text") -> None:
        """Count a batch of documents on top of all that was added before."""
        counts = line_counts(batch, text, self.min_chars)
        known = self._all("decided")
        if known is not None:
            counts = counts.join(known.select(*_HASHES).hint("merge"), _HASHES, "left_anti")
        self._put(0, counts)
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fan:
            self._compact(level)
            level += 1

    def decided(self) -> DataFrame:
        """(h, g) of the keys in at least ``threshold`` of the documents added, as a table of its own."""
        path = f"{self.root}/decided"
        runs = self._all()
        if runs is None:
            return self.spark.createDataFrame([], "h long, g long")
        runs.groupBy(*_HASHES).agg(F.sum("n").alias("n")).filter(F.col("n") >= self.threshold) \
            .select(*_HASHES).write.parquet(path)
        return self.spark.read.parquet(path)

    def close(self) -> None:
        """Remove the runs; the table of ``decided`` stays."""
        for names in self.levels:
            for name in names:
                self._drop(name)
        self.levels = []

    def _all(self, where: str | None = None) -> DataFrame | None:
        out = None
        for names in self.levels:
            for name in names:
                run = self.spark.table(name)
                run = run.filter(where) if where else run
                out = run if out is None else out.union(run)
        return out

    def _put(self, level: int, counts: DataFrame) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        counts.select(*_HASHES, "n", (F.col("n") >= self.threshold).alias("decided")) \
            .write.partitionBy("decided").bucketBy(self.buckets, *_HASHES).sortBy(*_HASHES) \
            .option("path", f"{self.root}/{name}").saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def _compact(self, level: int) -> None:
        old, merged = self.levels[level], None
        for name in old:
            run = self.spark.table(name)
            merged = run if merged is None else merged.union(run)
        self._put(level + 1, merged.groupBy(*_HASHES).agg(F.sum("n").alias("n")))
        self.levels[level] = []
        for name in old:
            self._drop(name)

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove(self.spark, f"{self.root}/{name}")


def file_batches(table: DataFrame, batches: int = BATCHES) -> list[DataFrame]:
    """A Parquet table in ``batches`` batches of whole files (fewer where it has fewer
    files), so that no file is read for two of them."""
    files = sorted(table.inputFiles())
    n = max(1, min(batches, len(files)))
    if n == 1:
        return [table]
    spark, edges = table.sparkSession, [len(files) * k // n for k in range(n + 1)]
    return [spark.read.schema(table.schema).parquet(*files[a:b]) for a, b in zip(edges, edges[1:])]


def repeated_lines(docs: DataFrame, decided: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, n_lines, dropped, kept) for each row of ``docs``: the positions, from 0, of the
    lines whose keys are in ``decided``, and the other lines, joined by a line feed."""
    # Rows are named by 128 bits of doc_id and text: equal rows lose the same lines.
    named = [F.xxhash64("doc_id", "text").alias("a"), F.xxhash64("text", "doc_id", F.lit(1)).alias("b")]
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    places = rows.select(*named, F.posexplode(_lines("text")).alias("at", "line")) \
        .select("a", "b", "at", line_key(F.col("line")).alias("key")) \
        .filter(F.length("key") >= min_chars).select("a", "b", "at", *_hashed("key")) \
        .join(decided, _HASHES, "left_semi") \
        .groupBy("a", "b").agg(F.sort_array(F.collect_set("at")).alias("dropped"))
    found = rows.select("*", *named).join(places, ["a", "b"], "left")
    none = F.array().cast("array<int>")
    found = found.select("doc_id", "text", F.coalesce("dropped", none).alias("dropped"))

    def without(lines: Column) -> Column:
        starts = F.concat(F.array(F.lit(0)), F.transform("dropped", lambda x: x + 1))
        ends = F.concat(F.col("dropped"), F.array(F.size(lines)))
        return F.array_join(F.flatten(F.zip_with(starts, ends, lambda s, e: F.slice(lines, s + 1, e - s))), "\n")

    # The lines are a lambda's argument, so that the text is split once for all slices.
    kept = F.when(F.size("dropped") == 0, F.coalesce("text", F.lit(""))) \
        .otherwise(F.transform(F.array(_lines("text")), without)[0])
    return found.select("doc_id", F.size(_lines("text")).cast("long").alias("n_lines"), "dropped", kept.alias("kept"))


def drop_repeated_lines(docs: DataFrame, batches: list[DataFrame] | None = None, threshold: int = THRESHOLD,
                        min_chars: int = MIN_CHARS, fan: int = FAN, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``repeated_lines`` of ``docs``, counted over ``batches`` (the whole of ``docs``
    in parts; one batch if not given)."""
    runs = LineRuns(docs.sparkSession, threshold, fan, min_chars)
    for batch in batches or [docs]:
        runs.add(batch, text)
    decided = runs.decided()
    runs.close()
    return repeated_lines(docs, decided, doc_id, text, min_chars)


SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (SELECT r, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM docs),
keyed AS (
  SELECT r, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM line),
frequent AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
judged AS (SELECT k.*, f.key IS NOT NULL AS gone FROM keyed k LEFT JOIN frequent f ON k.key = f.key),
put AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS kept FROM judged GROUP BY r)
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM put JOIN docs USING (r)
"""
