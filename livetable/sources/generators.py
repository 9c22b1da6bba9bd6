"""Built-in generator sources (rate) and the socket line source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_rate(spark: SparkSession, rows_per_second: int = 10,
              num_partitions: int = 2, ramp_up: str = "0s",
              micro_batch: bool = False, rows_per_batch: int = 10) -> DataFrame:
    """``timestamp, value`` rows.  ``micro_batch=True`` uses the deterministic
    ``rate-micro-batch`` source (a fixed count per batch), which tests need."""
    if micro_batch:
        return (spark.readStream.format("rate-micro-batch")
                .option("rowsPerBatch", rows_per_batch)
                .option("numPartitions", num_partitions).load())
    return (spark.readStream.format("rate")
            .option("rowsPerSecond", rows_per_second)
            .option("rampUpTime", ramp_up)
            .option("numPartitions", num_partitions).load())


def read_socket(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a TCP socket (debugging only: no replay, no fault tolerance)."""
    return (spark.readStream.format("socket")
            .option("host", host).option("port", port).load())
