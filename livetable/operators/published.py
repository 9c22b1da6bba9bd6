"""Published models as numbered versions, and serving that records the version.

A publication is one small file ``v=<n>.json`` in the registry's folder, created only
where none of that number exists: of two publishers that try the same number at once,
one gets it and the other takes the next.  A published version never changes, and the
highest one is current.  A file whose text is incomplete belongs to a publisher that is
still writing, or that was lost; readers pass over it and its number is not used again.

Serving looks the current version up once for each micro-batch, so all answers of a batch
are served by one model, and the output says by which (``model_version``).

An empty or absent folder has no version.  The folder holds one file for each
publication, which the driver lists; models themselves are on storage.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from livetable.operators import recommend as rec


class Published(NamedTuple):
    version: int
    path: str
    rmse: float


def _folder(spark: SparkSession, root: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers taken so far, ascending, finished or not."""
    folder, fs = _folder(spark, root)
    if not fs.exists(folder):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(folder)]
    return sorted(int(n[2:-5]) for n in names if n.startswith("v=") and n.endswith(".json") and n[2:-5].isdigit())


def _read(spark: SparkSession, root: str, number: int) -> Published | None:
    folder, fs = _folder(spark, root)
    stream = fs.open(folder.suffix(f"/v={number}.json"))
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        entry = json.loads(text)
    except ValueError:
        return None
    return Published(number, entry["path"], entry["rmse"])


def put_if_absent(spark: SparkSession, root: str, number: int, path: str, rmse: float) -> bool:
    """Publish ``path`` as version ``number``; False where that number is taken."""
    folder, fs = _folder(spark, root)
    target = folder.suffix(f"/v={number}.json")
    text = json.dumps({"path": path, "rmse": rmse}).encode()
    if fs.getScheme() == "file":
        # Hadoop's local file system looks first and creates then; the system's own call is one step.
        local = folder.toUri().getPath()
        os.makedirs(local, exist_ok=True)
        try:
            with open(f"{local}/v={number}.json", "xb") as f:
                f.write(text)
        except FileExistsError:
            return False
        return True
    try:
        out = fs.create(target, False)
    except Py4JJavaError as e:
        if fs.exists(target):
            return False
        raise e
    try:
        out.write(bytearray(text))
    finally:
        out.close()
    return True


def publish(spark: SparkSession, root: str, path: str, rmse: float, gate: float = rec.RMSE_GATE) -> int | None:
    """Publish a saved model under the next free number; None where the gate refuses it."""
    if not rec.passes_gate(rmse, gate):
        return None
    number = max(_numbers(spark, root), default=0) + 1
    while not put_if_absent(spark, root, number, path, float(rmse)):
        number += 1
    return number


def versions(spark: SparkSession, root: str) -> list[Published]:
    """All finished publications, oldest first."""
    found = (_read(spark, root, n) for n in _numbers(spark, root))
    return [p for p in found if p is not None]


def current(spark: SparkSession, root: str) -> Published | None:
    """The highest finished version."""
    for number in reversed(_numbers(spark, root)):
        found = _read(spark, root, number)
        if found is not None:
            return found
    return None


def train_and_publish(spark: SparkSession, ratings: DataFrame, model_path: str, root: str,
                      gate: float = rec.RMSE_GATE, **als_kw) -> tuple[int | None, float]:
    """Train on the ratings' training split, evaluate on the rest, and publish behind the
    gate: (version or None, RMSE).  A refused model is not saved.  The ratings are persisted
    while training and evaluation read them."""
    from livetable.operators.split import hash_split
    ratings = ratings.persist()
    try:
        train_part, test_part = hash_split(ratings, ["student_id", "question_id"], 8, 10, rec.SPLIT_SEED)
        model = rec.train(train_part, **als_kw)
        rmse = rec.evaluate(rec.predict(model, test_part))
    finally:
        ratings.unpersist()
    if not rec.passes_gate(rmse, gate):
        return None, rmse
    model.write().overwrite().save(model_path)
    return publish(spark, root, model_path, rmse, gate), rmse


def serve_versioned(spark: SparkSession, root: str, output: Callable[[DataFrame, int], None],
                    k: int = rec.TOP_SUBSET) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function like :func:`recommend.serve_batch`, by the version that is
    current when the batch begins; rows get ``model_version``.  The model is loaded again
    only when the version moved.  Without any version the batch fails and stays open."""
    held: dict = {"by": None, "model": None}

    def recommender(students: DataFrame) -> DataFrame:
        now = current(spark, root)
        if now is None:
            raise rec.NoModel(f"no model in the registry {root}")
        if held["by"] != now:
            held["model"], held["by"] = ALSModel.load(now.path), now
        return rec.recommend_subset(held["model"], students, k)

    def tagged(served: DataFrame, batch_id: int) -> None:
        output(served.withColumn("model_version", F.lit(held["by"].version)), batch_id)

    return rec.serve_batch(recommender, tagged)
