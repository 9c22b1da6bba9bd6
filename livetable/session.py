"""Session construction and the shared working folder.

Streaming checkpoints, sink folders and lineage cuts must live on storage that
every executor and a restarted driver can see.  The cluster names that folder in
``spark.checkpoint.dir``; we read it from the session and only fall back to a
fresh temporary folder when running in local mode (tests, the bench) and the
setting is absent.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter at scale; all are plain Spark options.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Partial aggregation and the per-partition top-k of ranking windows keep
    # hot keys from landing whole in one task.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    # Large streaming state goes to RocksDB instead of the executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str = "local[8]", app: str = "livetable",
                  shuffle_partitions: int | None = None, checkpoint_dir: str | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings this library expects.

    ``shuffle_partitions`` defaults to 8 in local mode only.  On a cluster the
    cluster's own setting stays; it should be sized for the data (AQE then
    coalesces small partitions), and a streaming query keeps the count it
    started with because its state is partitioned by it.
    """
    b = SparkSession.builder.master(master).appName(app).config("spark.ui.enabled", "false")
    if shuffle_partitions is None and master.startswith("local"):
        shuffle_partitions = 8
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if checkpoint_dir:
        use_checkpoint_dir(spark, checkpoint_dir)
    return spark


def use_checkpoint_dir(spark: SparkSession, path: str) -> None:
    """Use ``path`` as the shared folder only when the session names none
    (tests, the bench); a cluster's ``spark.checkpoint.dir`` always wins."""
    sc = spark.sparkContext
    if sc.getConf().get("spark.checkpoint.dir", None):
        return
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    sc.setCheckpointDir(path)


def _checkpoint_root(spark: SparkSession) -> str:
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        # Spark adds a folder with a random name for each context; what must be
        # found again after a restart lives beside it.
        return current.get().rstrip("/").rsplit("/", 1)[0]
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster needs a shared folder "
            "for checkpoints and sink output")
    root = tempfile.mkdtemp(prefix="livetable-ckpt-")
    sc.setCheckpointDir(root)
    return root


def shared_dir(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the cluster's shared checkpoint folder.

    ``unique=True`` appends a fresh id so that a run never resumes another
    run's streaming checkpoint by accident.
    """
    names = list(parts) + ([uuid.uuid4().hex[:12]] if unique else [])
    return "/".join([_checkpoint_root(spark), "livetable", *names])


@contextmanager
def open_writers(spark: SparkSession, values: int) -> Iterator[None]:
    """Writes by partition columns of at most ``values`` different values: a task keeps a
    file open for each value, where it would otherwise first sort all its rows by them."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(values))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package's code (once per session), for clusters and
    drivers whose PYTHONPATH they do not share."""
    sc = spark.sparkContext
    if getattr(sc, "_livetable_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    if os.path.isdir(package):  # not when it runs from an archive already
        path = os.path.join(tempfile.mkdtemp(prefix="livetable-code-"), "livetable_code.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(package):
                for name in sorted(n for n in names if n.endswith(".py")):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
        sc.addPyFile(path)
    sc._livetable_shipped = True
