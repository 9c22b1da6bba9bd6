"""The state of a streaming query as a table, through Spark's state data source.

The state is read from the checkpoint, with or without the query running; nothing is
replayed.  One row for each key of a stateful operator, over all its state partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_state(spark: SparkSession, checkpoint: str, operator: int = 0, batch_id: int | None = None,
               store: str | None = None) -> DataFrame:
    """(key columns, value columns, partition_id) of operator number ``operator``, as of
    ``batch_id`` (default: the last committed batch)."""
    r = spark.read.format("statestore").option("path", checkpoint).option("operatorId", operator)
    if batch_id is not None:
        r = r.option("batchId", batch_id)
    if store:
        r = r.option("storeName", store)
    rows = r.load()
    return rows.select("key.*", "value.*", "partition_id")


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators that a checkpoint holds, with their partitions and batches."""
    return spark.read.format("state-metadata").load(checkpoint)


def counts_in_state(spark: SparkSession, checkpoint: str, key: str, name: str = "count",
                    batch_id: int | None = None) -> DataFrame:
    """(key, count) of a streaming ``groupBy(key).count()`` from its state."""
    rows = read_state(spark, checkpoint, batch_id=batch_id)
    held = [c for c in rows.columns if c not in (key, "partition_id")]
    return rows.select(F.col(key), F.col(held[0]).alias(name))
