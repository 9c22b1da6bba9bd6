"""Aggregations, sorts and top-k.

All of these compile to a partial (map-side) aggregate, one shuffle on the
group key and a final aggregate, so a key that holds a large share of the rows
reaches the final stage as at most one row per map task.  Top-k compiles to
``TakeOrderedAndProject`` in batch (per-partition top-k, then a merge of k rows
per partition) and to sort + limit over the aggregate in streaming complete
mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, key: str | list[str], name: str = "count",
             count_col: str | None = None) -> DataFrame:
    """``groupBy(key).count()``; ``count_col`` counts non-null values instead."""
    keys = [key] if isinstance(key, str) else list(key)
    agg = F.count(F.col(count_col)) if count_col else F.count(F.lit(1))
    return df.groupBy(*keys).agg(agg.alias(name))


def filtered_stats(df: DataFrame, cond: Column, key: str, value: str,
                   count_col: str | None = None, count_name: str = "counts",
                   avg_name: str = "mean_signal", digits: int | None = 6) -> DataFrame:
    """Count and average of ``value`` per ``key`` over rows passing ``cond``.

    ``count_col=None`` counts rows (SQL ``count(*)``); a column name counts its
    non-null values (DSL ``count('col)``).
    """
    cnt = F.count(F.col(count_col)) if count_col else F.count(F.lit(1))
    avg = F.avg(F.col(value))
    if digits is not None:
        avg = F.round(avg, digits)
    return df.filter(cond).groupBy(key).agg(cnt.alias(count_name), avg.alias(avg_name))


def top_n(df: DataFrame, order: list[Column], n: int = 10) -> DataFrame:
    """Sort then limit.  Put a unique tie-break last in ``order``."""
    return df.orderBy(*order).limit(n)


def top_n_with_attr(df: DataFrame, key: str, attr: str, n: int = 10,
                    name: str = "count") -> DataFrame:
    """Top-n keys by row count, carrying one attribute of the key.

    The attribute is taken with ``min`` (one fixed answer; equal to ``first``
    when the attribute depends on the key alone).

    ``min`` of a string has no fixed-width buffer, so Spark aggregates it by
    sorting.  In batch the rows are first counted per (key, attribute) with a
    hash aggregate; only those pairs reach the sort-based step.  Streaming
    complete mode allows one aggregation, so a stream takes the single step.
    """
    if df.isStreaming:
        agg = df.groupBy(key).agg(F.min(attr).alias(attr), F.count(F.col(key)).alias(name))
    else:
        pairs = df.groupBy(key, attr).agg(F.count(F.col(key)).alias(name))
        agg = pairs.groupBy(key).agg(F.min(attr).alias(attr), F.sum(name).alias(name))
    return top_n(agg, [F.desc(name), F.asc(key)], n)


def lowest_by(df: DataFrame, key: str, score: str, item: str, n: int = 10,
              score_name: str = "minscore") -> DataFrame:
    """Keys with the lowest minimum score, each with the item of that minimum
    (ties: smallest item).

    In batch, the minimum per key is a hash aggregate of numbers; only the n keys
    it leaves are joined back to the rows for their items.  Streaming complete mode
    allows one aggregation, so a stream takes both in a single step.
    """
    rows = df.filter(F.col(score).isNotNull())
    if df.isStreaming:
        agg = rows.groupBy(key).agg(
            F.min(score).alias(score_name),
            F.min_by(F.col(item), F.struct(F.col(score), F.col(item))).alias(item))
        return top_n(agg, [F.asc(score_name), F.asc(key)], n)
    low = top_n(rows.groupBy(key).agg(F.min(score).alias(score_name)),
                [F.asc(score_name), F.asc(key)], n)
    k, s = low[key].alias("_key"), low[score_name]
    found = rows.select(key, score, item).join(low.select(k, s), (F.col(key).eqNullSafe(F.col("_key")))
                                               & (F.col(score) == F.col(score_name)))
    items = found.groupBy(key, score_name).agg(F.min(item).alias(item))
    return top_n(items.select(key, score_name, item), [F.asc(score_name), F.asc(key)], n)


def rmse(df: DataFrame, label: str, prediction: str, name: str = "rmse",
         digits: int | None = None) -> DataFrame:
    """Root mean square error as one aggregate row (``n`` rows used)."""
    err = F.col(label).cast("double") - F.col(prediction).cast("double")
    r = F.sqrt(F.avg(err * err))
    if digits is not None:
        r = F.round(r, digits)
    clean = df.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull()
                      & ~F.isnan(F.col(prediction).cast("double")))
    return clean.agg(r.alias(name), F.count(F.lit(1)).alias("n"))


def rmse_vs_group_mean(df: DataFrame, group: str, label: str,
                       name: str = "rmse", digits: int | None = 6) -> DataFrame:
    """RMSE of ``label`` against its per-``group`` mean (a baseline model).

    The squared error of a group is its size times its variance (Spark merges
    central moments, so large means lose no digits): two chained aggregates, no
    join back to the rows, so a hot group costs nothing extra.
    """
    x = F.col(label).cast("double")
    per = (df.filter(F.col(label).isNotNull()).groupBy(group)
           .agg(F.count(F.lit(1)).alias("_n"), F.var_pop(x).alias("_v")))
    sse = F.sum(F.col("_v") * F.col("_n"))
    r = F.sqrt(sse / F.sum("_n"))
    if digits is not None:
        r = F.round(r, digits)
    return per.agg(r.alias(name), F.sum("_n").alias("n"))
