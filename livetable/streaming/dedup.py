"""Two-stage streaming de-duplication for inputs with hot groups of copies.

Spark's streaming ``dropDuplicates`` shuffles every row to the task owning its
key and has no map-side step, so a group of copies holding a large share of a
micro-batch lands whole in one task.  Stage 1 (``foreachBatch``) reduces each
micro-batch to its distinct keys with a batch aggregate, which collapses copies
map-side before any shuffle, and appends them under ``batch_id=<n>``.  Stage 2
streams that folder through the stateful de-duplication, which now sees each
key at most once per micro-batch.  Stage 1 only appends: a replayed batch adds
a second copy of its keys, which stage 2 drops like any other repeat, and no
file that stage 2 may be reading is ever deleted.  Results stay exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from livetable.sources.files import batch_bytes
from livetable.streaming.sinks import start_query


def start_batch_distinct(df: DataFrame, keys: list[str], path: str, checkpoint: str,
                         trigger: dict | None = None) -> StreamingQuery:
    """Stage 1: the distinct ``keys`` of each micro-batch, appended under
    ``batch_id=<n>``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.select(*keys).distinct()
         .withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("append").partitionBy("batch_id").parquet(path))
    return start_query(df, "foreach_batch", checkpoint, "append", batch_fn=write,
                       trigger=trigger)


def read_batch_distinct(spark: SparkSession, path: str, df: DataFrame,
                        keys: list[str]) -> DataFrame:
    """Stage 2 input: the stage-1 folder as a stream (key types from ``df``).

    The folder is created when absent, so stage 2 can start before stage 1
    has finished its first batch."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)
    fields = [df.schema[c] for c in keys] + [StructField("batch_id", LongType(), True)]
    return (spark.readStream.schema(StructType(fields))
            .option("maxBytesPerTrigger", str(batch_bytes(spark)))
            .parquet(path).select(*keys))
