"""Starting streaming queries and the sinks we use.

* ``parquet`` (append mode): Spark's file sink, exactly-once by its own log.
* ``snapshot`` (complete mode): each batch's full result is written via
  ``foreachBatch`` as version ``v=<batch_id>``; a replayed batch rewrites its
  own version.  :func:`read_snapshot` reads the newest version whose write
  committed (``_SUCCESS``), so a reader never sees a half-written snapshot
  and a failed write leaves the previous version readable.  Versions older
  than the previous committed one are removed.
* ``updates`` (update mode): each batch's changed rows are written under
  ``batch_id=<n>`` with dynamic partition overwrite, so a replay replaces its
  own partition; :func:`latest_updates` gives the current value per key.
* ``memory``: driver-held table, small results and tests only.
* ``console``: debugging only.

Checkpoints go under the shared folder (``spark.checkpoint.dir``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from livetable.operators.registry import latest_per_key


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_versions(spark: SparkSession, root: str, committed: bool = False) -> list[int]:
    """Batch ids of the ``v=<n>`` folders under ``root``, ascending (a
    driver-side listing of folder names); ``committed`` keeps only those
    whose write finished (``_SUCCESS``)."""
    path, fs = _fs(spark, root)
    if not fs.exists(path):
        return []
    out = []
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v="):
            if committed and not fs.exists(st.getPath().suffix("/_SUCCESS")):
                continue
            out.append(int(name[2:]))
    return sorted(out)


def drop_versions(spark: SparkSession, root: str, below: int) -> None:
    """Remove the ``v=<n>`` folders with ``n < below``."""
    for v in list_versions(spark, root):
        if v < below:
            p, fs = _fs(spark, f"{root}/v={v}")
            fs.delete(p, True)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest committed version written by the ``snapshot`` sink."""
    done = list_versions(spark, path, committed=True)
    if not done:
        raise FileNotFoundError(f"no committed snapshot under {path}")
    return spark.read.parquet(f"{path}/v={done[-1]}")


def _snapshot_writer(path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{path}/v={batch_id}")
        # Keep this version and the committed one before it (a reader may
        # still be on it); older ones, and unfinished earlier attempts, go.
        before = [v for v in list_versions(spark, path, committed=True) if v < batch_id]
        drop_versions(spark, path, before[-1] if before else batch_id)
    return write


def _updates_writer(path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(path))
    return write


def start_query(df: DataFrame, sink: str, checkpoint: str, output_mode: str = "append",
                path: str | None = None, query_name: str | None = None,
                trigger: dict | None = None, options: dict | None = None,
                batch_fn: Callable[[DataFrame, int], None] | None = None,
                partition_by: list[str] | None = None) -> StreamingQuery:
    """Start ``df`` on a sink.

    ``trigger`` is passed to ``DataStreamWriter.trigger`` (for example
    ``{"availableNow": True}``, ``{"processingTime": "5 seconds"}`` or
    ``{"continuous": "1 second"}``); default is as-soon-as-possible.
    ``partition_by`` lays out a ``parquet`` sink in folders per value (for
    example per day), so readers of the output prune by that column.
    """
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if trigger:
        w = w.trigger(**trigger)
    if sink == "parquet":
        w = w.format("parquet").option("path", path)
        if partition_by:
            w = w.partitionBy(*partition_by)
    elif sink == "snapshot":
        w = w.foreachBatch(_snapshot_writer(path))
    elif sink == "updates":
        w = w.foreachBatch(_updates_writer(path))
    elif sink == "foreach_batch":
        w = w.foreachBatch(batch_fn)
    elif sink in ("memory", "console", "noop"):
        w = w.format(sink)
    else:
        w = w.format(sink)
        if path:
            w = w.option("path", path)
    return w.start()


def run_available_now(df: DataFrame, sink: str, checkpoint: str,
                      output_mode: str = "append", path: str | None = None,
                      query_name: str | None = None, options: dict | None = None,
                      batch_fn=None, timeout_s: float | None = None,
                      partition_by: list[str] | None = None) -> StreamingQuery:
    """Process everything available now in as many batches as needed, stop."""
    q = start_query(df, sink, checkpoint, output_mode, path, query_name,
                    {"availableNow": True}, options, batch_fn, partition_by)
    return wait_query(q, timeout_s)


def wait_query(q: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait for an ``availableNow`` query to finish; raise its error."""
    finished = q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    if finished is False:
        q.stop()
        raise TimeoutError(f"streaming query did not finish in {timeout_s}s")
    if q.exception() is not None:  # pragma: no cover - surfaced by await
        raise RuntimeError(str(q.exception()))
    return q


def dropped_by_watermark(q: StreamingQuery) -> int:
    """Rows that stateful operators of ``q`` refused as too late, in the batches
    Spark keeps progress of (the last hundred); ``streaming.progress`` sums whole runs."""
    return sum(op["numRowsDroppedByWatermark"] or 0
               for p in q.recentProgress for op in (p["stateOperators"] or []))


def latest_updates(spark: SparkSession, path: str, keys: list[str],
                   values: list[str]) -> DataFrame:
    """Current value per key from an ``updates`` sink (newest batch wins)."""
    log = spark.read.parquet(path)
    o = F.struct(F.col("batch_id"))
    return log.groupBy(*keys).agg(*[F.max_by(F.col(v), o).alias(v) for v in values])


def foreach_batch_outputs(outputs: list[Callable[[DataFrame, int], None]],
                          skip_empty: bool = True) -> Callable[[DataFrame, int], None]:
    """One ``foreachBatch`` function feeding several outputs from one read.

    The batch is persisted once when there is more than one output, and
    released afterwards; empty batches are skipped (``isEmpty``, not count).  In
    complete mode pass ``skip_empty=False``: an empty result is an empty table.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        if skip_empty and batch.isEmpty():
            return
        many = len(outputs) > 1
        if many:
            batch = batch.persist()
        try:
            for out in outputs:
                out(batch, batch_id)
        finally:
            if many:
                batch.unpersist()
    return run


def jdbc_snapshot(df: DataFrame, url: str, table: str, properties: dict) -> None:
    """Overwrite a database table with ``df`` (truncate keeps the table DDL).

    Rows are written by the executors in parallel; no single-partition step.
    """
    (df.write.mode("overwrite").option("truncate", "true")
     .jdbc(url, table, properties=properties))


def _has_table(conn, table: str) -> bool:
    """Asks the database's own catalog; names may be stored in another case."""
    schema, _, name = table.rpartition(".")
    found = conn.getMetaData().getTables(None, schema or None, None, None)
    try:
        while found.next():
            if found.getString("TABLE_NAME").lower() == name.lower():
                return True
        return False
    finally:
        found.close()


def jdbc_append_idempotent(spark: SparkSession, df: DataFrame, batch_id: int,
                           url: str, table: str, properties: dict) -> None:
    """Append a micro-batch keyed by ``batch_id``: rows of an earlier attempt
    of the same batch are deleted first, so a replay leaves the table as one
    clean copy (exactly-once output together with the checkpointed offsets).
    """
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in properties.items():
        props.setProperty(k, str(v))
    conn = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        if _has_table(conn, table):  # absent before the first batch
            st = conn.prepareStatement(f"DELETE FROM {table} WHERE batch_id = ?")
            st.setLong(1, batch_id)
            st.executeUpdate()
            st.close()
    finally:
        conn.close()
    (df.withColumn("batch_id", F.lit(batch_id).cast("long"))
     .write.mode("append").jdbc(url, table, properties=properties))


def snapshot_path_writer(path: str):
    """``foreachBatch`` output: the batch as snapshot version ``v=<batch_id>``
    of ``path`` (read it with :func:`read_snapshot`)."""
    return _snapshot_writer(path)


def updates_path_writer(path: str):
    """``foreachBatch`` output: write the batch under ``batch_id=<n>``."""
    return _updates_writer(path)


__all__ = ["start_query", "run_available_now", "wait_query", "read_snapshot",
           "list_versions", "drop_versions", "latest_updates",
           "foreach_batch_outputs", "jdbc_snapshot", "jdbc_append_idempotent",
           "snapshot_path_writer", "updates_path_writer", "latest_per_key"]
