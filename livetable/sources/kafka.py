"""Kafka source and sink, kept thin.

The Kafka connector jar is not on this image's classpath, so these factories
are not exercised here; tests feed rows with the Kafka record schema instead
(:func:`kafka_rows`).  Offsets live in the streaming checkpoint, never in
consumer auto-commit, so a restart neither loses nor doubles records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_kafka(spark: SparkSession, servers: str, topic: str,
               starting_offsets: str = "latest",
               min_partitions: int | None = None,
               max_offsets_per_trigger: int | None = None, **options) -> DataFrame:
    """Kafka records as a stream.

    ``minPartitions`` (default: the cluster's cores) lets Spark cut the offset
    range of a large topic partition into several tasks, so a partition that
    holds a large share of the records is not read by one task.
    ``maxOffsetsPerTrigger`` bounds each micro-batch when a backlog is read.
    """
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets)
         .option("minPartitions", str(min_partitions or spark.sparkContext.defaultParallelism)))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(int(max_offsets_per_trigger)))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load()


def kafka_value(df: DataFrame, name: str = "value") -> DataFrame:
    """Decode the record value to text: ``CAST(value AS STRING)``."""
    return df.select(F.col("value").cast("string").alias(name))


def kafka_rows(df: DataFrame, value: Column, topic: str, offset: Column,
               timestamp: Column, partitions: int = 4) -> DataFrame:
    """Rows shaped like Kafka records, for replaying a table as a topic."""
    return df.select(
        F.lit(None).cast("binary").alias("key"),
        F.encode(value, "UTF-8").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(offset, F.lit(partitions)).cast("int").alias("partition"),
        offset.cast("long").alias("offset"),
        timestamp.alias("timestamp"),
        F.lit(0).alias("timestampType"))


def write_kafka(df: DataFrame, servers: str, topic: str, checkpoint: str,
                output_mode: str = "append"):
    """Start a Kafka sink of the column ``value`` (and ``key``, where there is one).
    Other columns have no place in a record, so they are refused."""
    extra = set(df.columns) - {"key", "value"}
    if "value" not in df.columns or extra:
        raise ValueError(f"a Kafka sink takes a value and at most a key, not {df.columns}")
    return (df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
            .writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("topic", topic)
            .option("checkpointLocation", checkpoint)
            .outputMode(output_mode).start())
