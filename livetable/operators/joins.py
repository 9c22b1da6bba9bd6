"""Equi-join of a large side with a smaller one.

The join is stated and no more: Spark broadcasts a side whose planned size is
under ``spark.sql.autoBroadcastJoinThreshold``, and AQE re-plans with runtime
sizes and splits skewed partitions.  A hint would switch both checks off.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def attach(big: DataFrame, small: DataFrame, on: str | list[str],
           how: str = "inner") -> DataFrame:
    """``big.join(small, on, how)``."""
    return big.join(small, on, how)
