"""Cutting lineage, and small values from data of any size."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession, functions as F

from livetable.session import _checkpoint_root


def settle(df: DataFrame) -> DataFrame:
    """The same rows, computed once and kept in the cluster's shared checkpoint
    folder: a lost executor costs no recomputation, and an iteration's plan stays
    short.  The files go when the DataFrame does
    (``spark.cleaner.referenceTracking.cleanCheckpoints``)."""
    _checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def shard_count(docs: DataFrame, text: str, shard_bytes: int) -> int:
    """Number of shards of about ``shard_bytes`` of text, at least 1."""
    total = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    return max(1, -(-int(total) // shard_bytes))


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return df.select(*columns) if columns else df


def ship(spark: SparkSession) -> None:
    """Give the executors this package's code (once per session), for drivers whose
    PYTHONPATH they do not share."""
    sc = spark.sparkContext
    if getattr(sc, "_livetable_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(package):
        path = os.path.join(tempfile.mkdtemp(prefix="livetable-code-"), "livetable_code.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(package):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(package)))
        sc.addPyFile(path)
    sc._livetable_shipped = True


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this run in the shared folder, through Spark's file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
