"""File sources (parquet tables, text lines, delimited text, JSON lines).

Each reader takes ``stream=`` so the same operator code runs in batch and in
Structured Streaming.  Streaming file sources need a directory and a declared
schema; a table stored as one file is streamed from its folder with a file-name
filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from livetable import schemas


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}.parquet"


# Default micro-batch size of the file streams built here: this many bytes
# per core of the cluster, so that a backlog is read in bounded batches that
# still give every core several splits.
BATCH_BYTES_PER_CORE = 512 * 1024 * 1024


def batch_bytes(spark: SparkSession, per_core: int = BATCH_BYTES_PER_CORE) -> int:
    """``maxBytesPerTrigger`` sized to the cluster."""
    return max(1, spark.sparkContext.defaultParallelism) * per_core


def _limits(reader, max_files: int | None, max_bytes: int | None):
    """Bound each micro-batch of a file stream (files and/or bytes); a
    backlog read with ``availableNow`` is then split into several batches."""
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", str(int(max_bytes)))
    return reader


def _is_dir(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getFileStatus(p).isDirectory()


def read_table(spark: SparkSession, base: str, name: str,
               spread: bool = False) -> DataFrame:
    """Batch read of a parquet table (pushdown and pruning by Catalyst).

    ``spread=True`` guards CPU-heavy per-row work after the scan: when the
    scan yields fewer partitions than the cluster's default parallelism (a
    small table stored as one row group), rows are spread round-robin over
    that many tasks.  A large table already has more splits than cores, so
    at scale this adds no shuffle.
    """
    df = spark.read.parquet(table_path(base, name))
    return _spread(spark, df, df) if spread else df


def _spread(spark: SparkSession, df: DataFrame, scan: DataFrame) -> DataFrame:
    """Round-robin ``df`` over the cluster's cores when the batch ``scan`` of
    the same files has fewer splits than that."""
    want = spark.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() < want:
        return df.repartition(want)
    return df


def stream_table(spark: SparkSession, base: str, name: str,
                 max_files_per_trigger: int | None = None,
                 max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of a parquet table; schema taken from the footer."""
    path = table_path(base, name)
    scan = spark.read.parquet(path)
    reader = _limits(spark.readStream.schema(scan.schema), max_files_per_trigger,
                     max_bytes_per_trigger)
    if _is_dir(spark, path):
        df = reader.parquet(path)
    else:
        # A one-file table: stream its folder, keep only that file.
        df = reader.option("pathGlobFilter", f"{name}.parquet").parquet(base)
    return df


def read_lines(spark: SparkSession, path: str, stream: bool = False,
               max_files_per_trigger: int | None = None,
               max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Text lines as ``value string`` (the reference's socket/text input).

    A socket source is available through :func:`read_socket`; files are the
    tested path because this environment may not open ports.
    """
    if not stream:
        return spark.read.text(path)
    return _limits(spark.readStream, max_files_per_trigger, max_bytes_per_trigger).text(path)


def read_delimited(spark: SparkSession, path: str, schema: StructType,
                   sep: str = ";", header: bool = False, stream: bool = False,
                   max_files_per_trigger: int | None = None,
                   max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Delimited text with an explicit schema (no inference pass)."""
    r = spark.readStream if stream else spark.read
    r = r.schema(schema).option("sep", sep).option("header", str(header).lower())
    if stream:
        r = _limits(r, max_files_per_trigger, max_bytes_per_trigger)
    return r.csv(path)


def read_json_lines(spark: SparkSession, path: str,
                    schema: StructType = schemas.ANSWER, stream: bool = False,
                    timestamp_format: str = schemas.ANSWER_TS_FORMAT,
                    max_bytes_per_trigger: int | None = None) -> DataFrame:
    """JSON lines with a declared schema; malformed rows keep nulls."""
    r = _limits(spark.readStream, None, max_bytes_per_trigger) if stream else spark.read
    return (r.schema(schema).option("mode", "PERMISSIVE")
            .option("timestampNTZFormat", timestamp_format)
            .option("timestampFormat", timestamp_format)
            .json(path))
