"""Model registry: an append-only table of published models.

Replaces a key-value pointer (last write wins) with rows
``(model, item, path, rmse, created_at)``; the current model of a key is the
row with the newest ``created_at`` (ties: largest path).  Appends never
overwrite, so the history stays auditable and a reader never sees a half
update.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, StringType, StructField, StructType,
                               TimestampNTZType)

REGISTRY = StructType([
    StructField("model", StringType(), False),
    StructField("item", StringType(), False),
    StructField("path", StringType(), False),
    StructField("rmse", DoubleType(), True),
    StructField("created_at", TimestampNTZType(), False)])


def latest_per_key(df: DataFrame, keys: list[str], order: str, value: str,
                   extra: list[str] | None = None) -> DataFrame:
    """Newest ``value`` per key by ``order`` (ties: largest value).
    A key without any ``order`` has its largest value.

    ``max(order)`` per key is a hash aggregate; only rows that carry a key's
    newest ``order`` reach the second aggregate, which picks the value.
    """
    newest = df.groupBy(*keys).agg(F.max(order).alias("_newest"))
    names = [f"_k{i}" for i in range(len(keys))]
    newest = newest.select(*[F.col(k).alias(a) for k, a in zip(keys, names)], "_newest")
    same = F.col(order).eqNullSafe(F.col("_newest"))
    for k, a in zip(keys, names):
        same = same & F.col(k).eqNullSafe(F.col(a))
    rows = df.select(*keys, order, value, *(extra or [])).join(newest, same)
    cols = [F.max(value).alias(value), F.max(order).alias(order)]
    cols += [F.max_by(F.col(c), F.col(value)).alias(c) for c in (extra or [])]
    return rows.groupBy(*keys).agg(*cols)


def publish(spark: SparkSession, registry_path: str, model: str, item: str,
            path: str, rmse: float | None,
            created_at: _dt.datetime | None = None) -> None:
    """Append one registry row (a tiny write; the model itself is on storage)."""
    row = [(model, item, path, rmse, created_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))]
    spark.createDataFrame(row, REGISTRY).write.mode("append").parquet(registry_path)


def current_path(spark: SparkSession, registry_path: str, model: str,
                 item: str) -> str | None:
    """Path of the newest model for (model, item); None when nothing has been
    published yet (the registry's folder does not exist).  Any other failure to
    read the registry is raised."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(registry_path)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    reg = spark.read.schema(REGISTRY).parquet(registry_path)
    rows = (latest_per_key(reg.filter((F.col("model") == model) & (F.col("item") == item)),
                           ["model", "item"], "created_at", "path").select("path").take(1))
    return rows[0]["path"] if rows else None
