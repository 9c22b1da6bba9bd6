"""Event-time windows whose late rows are kept.

Spark's stateful operators drop rows behind the watermark.  Here every micro-batch is one
``foreachBatch`` step over versioned tables under ``root``:

* the watermark of a batch is the largest event time of the batches before it, less the
  delay (Spark's rule for one input);
* rows whose window ended at or before it are late and go to ``late/batch_id=<n>`` as they are;
* the others are counted per window and key (partial and final aggregate) and added to the open
  windows of the version before (``open/v=<n>``);
* windows that the batch's own new watermark closes go to ``final/batch_id=<n>``, once each.

A replayed batch starts from the same earlier version and rewrites its own, so the tables hold
every input row once: final counts, open counts and late rows add up to the rows that have an
event time; rows without one go to the late table.  State is one row for each open window and key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from livetable.functions.timefns import utc_micros
from livetable.streaming.sinks import list_versions, start_query, updates_path_writer


def _micros(spark: SparkSession, interval: str) -> int:
    """Length of an interval of days and smaller units."""
    return spark.sql(f"SELECT unix_micros(timestamp_micros(0) + INTERVAL {interval}) AS n").first()["n"]


def _before(spark: SparkSession, root: str, batch_id: int) -> int | None:
    done = [v for v in list_versions(spark, f"{root}/mark", committed=True) if v < batch_id]
    return done[-1] if done else None


def count_windows(root: str, time_col: str, key: str, length: str, delay: str):
    """The ``foreachBatch`` step (tumbling windows of ``length`` from the epoch)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        size, slack = _micros(spark, length), _micros(spark, delay)
        before = _before(spark, root, batch_id)
        top = spark.read.parquet(f"{root}/mark/v={before}").first()["top"] if before is not None else None
        at = utc_micros(time_col) if isinstance(batch.schema[time_col].dataType, T.TimestampNTZType) else F.unix_micros(time_col)
        batch = batch.withColumn("_at", at).persist()
        try:
            end = F.col("_at") - F.pmod("_at", F.lit(size)) + size
            late = F.col("_at").isNull() if top is None else F.col("_at").isNull() | (end <= top - slack)
            updates_path_writer(f"{root}/late")(batch.filter(late).drop("_at"), batch_id)
            counts = batch.filter(~late).groupBy(end.alias("end"), F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
            if before is not None:
                counts = counts.union(spark.read.parquet(f"{root}/open/v={before}")) \
                    .groupBy("end", "key").agg(F.sum("n").alias("n"))
            newest = batch.agg(F.max("_at").alias("top")).first()["top"]
            top = newest if top is None else max(top, newest or top)
            counts = counts.persist()
            try:
                closed = F.lit(False) if top is None else F.col("end") <= top - slack
                updates_path_writer(f"{root}/final")(counts.filter(closed), batch_id)
                counts.filter(~closed).write.mode("overwrite").parquet(f"{root}/open/v={batch_id}")
            finally:
                counts.unpersist()
            # The mark goes last: a version without it does not count.
            spark.createDataFrame([(top,)], "top long").write.mode("overwrite").parquet(f"{root}/mark/v={batch_id}")
        finally:
            batch.unpersist()
    return run


def start_windows_with_late(df: DataFrame, time_col: str, key: str, length: str, delay: str, root: str,
                            checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    return start_query(df, "foreach_batch", checkpoint, "append", trigger=trigger,
                       batch_fn=count_windows(root, time_col, key, length, delay))


def _shown(rows: DataFrame, spark: SparkSession, key: str, length: str) -> DataFrame:
    at = lambda c: F.timestamp_add("MICROSECOND", c, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
    return rows.select(at(F.col("end") - _micros(spark, length)).alias("window_start"), at(F.col("end")).alias("window_end"),
                       F.col("key").alias(key), F.col("n").alias("count"))


def final_windows(spark: SparkSession, root: str, key: str, length: str) -> DataFrame:
    """Closed windows: (window_start, window_end, key, count), zone-less UTC."""
    return _shown(spark.read.parquet(f"{root}/final"), spark, key, length)


def open_windows(spark: SparkSession, root: str, key: str, length: str) -> DataFrame:
    """Windows that may still change, as of the last committed batch."""
    v = list_versions(spark, f"{root}/mark", committed=True)[-1]
    return _shown(spark.read.parquet(f"{root}/open/v={v}"), spark, key, length)


def late_rows(spark: SparkSession, root: str) -> DataFrame:
    """Rows behind the watermark of their micro-batch (``batch_id``), as they came."""
    return spark.read.parquet(f"{root}/late")
