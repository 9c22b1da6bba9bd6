"""Missing ids in a run lo..hi.

* one missing id: XOR of all ids of the run, XOR of all present ids; the run's
  XOR has a closed form, so only the distinct present ids are scanned;
* any number missing: the run from ``spark.range`` anti-joined with the present
  ids (both sides partitioned by id, nothing collected);
* the same by counts: ids are marked in bitmaps of one range each, ranges that are
  full are done, and only the others are looked into, byte by byte, then bit by bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _xor_upto(n: Column) -> Column:
    """XOR of 0..n (n >= -1) by the period-4 rule."""
    r = F.pmod(n, F.lit(4))
    return (F.when(n < 0, F.lit(0)).when(r == 0, n).when(r == 1, F.lit(1))
            .when(r == 2, n + 1).otherwise(F.lit(0))).cast("long")


def missing_id_xor(df: DataFrame, col: str, lo: int | None = None,
                   hi: int | None = None) -> DataFrame:
    """One row: run bounds (default: smallest and largest present id), number
    of missing ids, XOR of the missing ids and, when exactly one is missing,
    that id."""
    ids = df.select(F.col(col).cast("long").alias("id")).filter(F.col("id").isNotNull())
    if lo is not None:
        ids = ids.filter(F.col("id") >= lo)
    if hi is not None:
        ids = ids.filter(F.col("id") <= hi)
    present = ids.distinct().agg(F.min("id").alias("_min"), F.max("id").alias("_max"),
                                 F.count(F.lit(1)).alias("_n"),
                                 F.coalesce(F.bit_xor("id"), F.lit(0).cast("long")).alias("_x"))
    lo_c = F.lit(lo).cast("long") if lo is not None else F.col("_min")
    hi_c = F.lit(hi).cast("long") if hi is not None else F.col("_max")
    out = present.select(lo_c.alias("lo"), hi_c.alias("hi"), "_n", "_x",
                         _xor_upto(hi_c).alias("_a"), _xor_upto(lo_c - 1).alias("_b"))
    out = out.select("lo", "hi",
                     (F.col("hi") - F.col("lo") + 1 - F.col("_n")).alias("n_missing"),
                     F.expr("_a ^ _b ^ _x").alias("xor_missing"))
    return out.withColumn("missing_id",
                          F.when(F.col("n_missing") == 1, F.col("xor_missing")))


def missing_ids(spark: SparkSession, df: DataFrame, col: str, lo: int, hi: int,
                num_partitions: int | None = None, name: str = "missing_id") -> DataFrame:
    """All ids of lo..hi that do not occur in ``df[col]``.

    Present ids are made distinct first.  Copies of one id collapse map-side;
    in an anti join AQE can split only the left side, so a repeated id on the
    right would otherwise stay whole in one task.  The distinct's hash
    partitioning on the id is the one the sort-merge join needs, so it adds
    no shuffle there.
    """
    run = spark.range(lo, hi + 1, 1, num_partitions).withColumnRenamed("id", name)
    present = df.select(F.col(col).cast("long").alias(name)).distinct()
    return run.join(present, name, "left_anti")


RANGE = 32768  # ids of one bitmap of ``bitmap_construct_agg`` (fixed value)


def missing_ids_by_range(spark: SparkSession, df: DataFrame, col: str, lo: int, hi: int,
                         name: str = "missing_id") -> DataFrame:
    """All ids of lo..hi that do not occur in ``df[col]``, by counting ranges.

    Each map task marks its ids in bitmaps of ``RANGE`` ids (4 KB), which are merged by
    range: no id is shuffled, a repeated id is one bit, and a range costs at most 4 KB from
    each task.  A range with all its ids ends there.  Of the others, only bytes with a gap
    and then only missing bits become rows.
    """
    size = F.least(F.lit(RANGE).cast("long"), F.lit(hi - lo + 1).cast("long") - F.col("range") * RANGE)
    at = F.col(col).cast("long") - F.lit(lo)
    marked = df.filter(F.col(col).cast("long").between(lo, hi)) \
        .select(F.floor(at / RANGE).cast("long").alias("range"), F.pmod(at, F.lit(RANGE)).alias("at")) \
        .groupBy("range").agg(F.bitmap_construct_agg("at").alias("bits"))
    ranges = spark.range(0, max(0, -(-(hi - lo + 1) // RANGE))).withColumnRenamed("id", "range").withColumn("size", size)
    gaps = ranges.join(marked, "range", "left") \
        .filter(F.coalesce(F.bitmap_count("bits"), F.lit(0)) < F.col("size"))
    part = gaps.select("range", "size", "bits", F.explode(F.sequence(F.lit(0), F.floor((F.col("size") - 1) / 8).cast("int"))).alias("byte"))
    value = F.coalesce(F.conv(F.hex(F.expr("substring(bits, byte + 1, 1)")), 16, 10).cast("int"), F.lit(0))
    part = part.select("range", "size", "byte", value.alias("value")).filter("value <> 255")
    bit = part.select("*", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("bit"))
    place = F.col("byte") * 8 + F.col("bit")
    return bit.filter(((F.col("value") / F.pow(F.lit(2), F.col("bit"))).cast("long") % 2 == 0) & (place < F.col("size"))) \
        .select((F.lit(lo).cast("long") + F.col("range") * RANGE + place).alias(name))
