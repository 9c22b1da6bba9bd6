"""Per-key ranking (top-k per group).

``row_number() <= k`` over a key lets Spark insert a partial
``WindowGroupLimit`` before the shuffle, so each map task sends at most k rows
per key: a key holding a third of all rows is cut to k rows per task before it
reaches its reducer.  Input is pre-aggregated per (key, item) first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def lowest_items_per_key(df: DataFrame, key: str, item: str, score: str,
                         k: int = 10, rank_name: str = "rank") -> DataFrame:
    """The k items with the lowest (minimum) score per key; ties by item."""
    per_item = (df.filter(F.col(score).isNotNull()).groupBy(key, item)
                .agg(F.min(score).alias(score)))
    w = Window.partitionBy(key).orderBy(F.asc(score), F.asc(item))
    return (per_item.withColumn(rank_name, F.row_number().over(w))
            .filter(F.col(rank_name) <= k))


def top_items_per_key(df: DataFrame, key: str, item: str, weight: str,
                      k: int = 3, rank_name: str = "rank",
                      total_name: str = "total") -> DataFrame:
    """The k items with the largest summed weight per key; ties by item."""
    per_item = df.groupBy(key, item).agg(F.sum(weight).alias(total_name))
    w = Window.partitionBy(key).orderBy(F.desc(total_name), F.asc(item))
    return (per_item.withColumn(rank_name, F.row_number().over(w))
            .filter(F.col(rank_name) <= k))
