"""Event-time windows, watermarks and de-duplication.

Sliding windows expand each row into ``length / slide`` rows before the
shuffle; the aggregation is partial+final, so a hot word costs one row per map
task and window.  A watermark bounds state: windows whose end is behind it are
evicted (update/append) and, in append mode, emitted once and final.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from livetable.functions.timefns import from_utc_micros, to_utc_instant, utc_micros
from livetable.streaming.progress import ProgressLog
from livetable.streaming.sinks import _fs


def with_event_time(df: DataFrame, col: str, name: str = "event_time") -> DataFrame:
    """Add an instant column usable by ``withWatermark`` (zone-less input is
    read as UTC; instants are kept)."""
    t = df.schema[col].dataType.typeName()
    c = to_utc_instant(col) if t == "timestamp_ntz" else F.col(col)
    return df.withColumn(name, c)


def windowed_count(df: DataFrame, time_col: str, key: str, length: str,
                   slide: str | None = None, watermark: str | None = None,
                   name: str = "count") -> DataFrame:
    """Count per (event-time window, key); ``slide=None`` gives tumbling
    windows.  Output: window_start, window_end (zone-less, UTC wall clock),
    key, count."""
    ev = with_event_time(df, time_col, "_et")
    if watermark:
        ev = ev.withWatermark("_et", watermark)
    w = F.window("_et", length, slide) if slide else F.window("_et", length)
    agg = ev.groupBy(w.alias("window"), F.col(key)).agg(F.count(F.lit(1)).alias(name))
    return agg.select(from_utc_micros(F.col("window.start")).alias("window_start"),
                      from_utc_micros(F.col("window.end")).alias("window_end"),
                      key, name)


def dedup_counts(df: DataFrame, keys: list[str], by: str,
                 name: str = "count") -> DataFrame:
    """Drop rows repeating ``keys``, then count rows per ``by``.

    On a stream without a watermark the de-duplication state grows without
    bound (the reference's form); see :func:`dedup_within` for the bounded one.
    """
    return df.dropDuplicates(keys).groupBy(by).agg(F.count(F.lit(1)).alias(name))


def run_in_time_order(spark: SparkSession, df: DataFrame, time_col: str, folder: str, slices: int,
                      run: Callable[[DataFrame], StreamingQuery]) -> list[StreamingQuery]:
    """Feed the batch ``df`` to a streaming query in event-time order.

    Files of a table are in no time order, and a watermark drops rows behind an
    earlier micro-batch.  The rows are therefore written once, in ``slices``
    consecutive time ranges of about equal size, each in a folder of its own; the slices' files
    then go to ``folder`` one slice after the other (renamed, not copied), and after each ``run`` takes
    the folder's stream through an ``availableNow`` query (one checkpoint for all).
    The table is read twice, whatever the number of slices: for the cuts and for the write.
    Rows that a stateful operator still refuses as late are an error.
    """
    at = utc_micros(time_col) if df.schema[time_col].dataType.typeName() == "timestamp_ntz" \
        else F.unix_micros(time_col)
    shares = [k / slices for k in range(1, slices)]
    cuts = sorted(set(df.select(at.alias("t")).approxQuantile("t", shares, 0.001))) if shares else []
    # Rows without a time go first; no window or delay concerns them.
    behind = [F.coalesce((at > F.lit(int(c))).cast("int"), F.lit(0)) for c in cuts]
    number = sum(behind[1:], behind[0]) if behind else F.lit(0)
    staged = f"{folder}_slices"
    df.withColumn("_slice", number).write.partitionBy("_slice").parquet(staged)
    target, fs = _fs(spark, folder)
    fs.mkdirs(target)
    queries = []
    for k in range(len(cuts) + 1):
        part, _ = _fs(spark, f"{staged}/_slice={k}")
        if fs.exists(part):
            for f in fs.listStatus(part):
                moved, _ = _fs(spark, f"{folder}/slice{k}-{f.getPath().getName()}")
                if not fs.rename(f.getPath(), moved):
                    raise RuntimeError(f"could not move {f.getPath()}")
        with ProgressLog(spark) as log:
            q = run(spark.readStream.schema(df.schema).parquet(folder))
            late = log.totals(q).rows_dropped
        if late:
            raise RuntimeError(f"{late} rows were behind the watermark")
        queries.append(q)
    fs.delete(_fs(spark, staged)[0], True)
    return queries


def dedup_within(df: DataFrame, time_col: str, keys: list[str], delay: str,
                 out: list[str] | None = None) -> DataFrame:
    """Drop repeats of ``keys`` arriving within ``delay`` of the first one;
    state is evicted once the watermark passes, so it stays bounded."""
    ev = with_event_time(df, time_col, "_et").withWatermark("_et", delay)
    d = ev.dropDuplicatesWithinWatermark(keys)
    return d.select(*(out or keys))
