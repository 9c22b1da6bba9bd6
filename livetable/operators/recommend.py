"""Recommendation: ratings from answers, ALS training behind a quality gate,
publication to a registry table, and scoring of the students of a batch.

Models and prediction are Spark ML's; the factors come from the solver of ``operators.als``,
the top-k lists from the exact search of ``operators.products``.  Nothing is collected except
the RMSE scalar that drives the gate, names of files, and item factors in bounded groups for
the search.
"""

from __future__ import annotations

import math
import time

from pyspark import StorageLevel
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from livetable.functions.ids import id_number, id_text, ids_to_text
from livetable.operators import registry as reg
from livetable.operators.als import fit
from livetable.operators.products import top_products

# Id prefixes of the answer messages (student, question).
STUDENT_PREFIX = "学生ID_"
QUESTION_PREFIX = "题目ID_"

# ALS settings and the acceptance rule of the trained model.
ALS_RANK = 20
ALS_MAX_ITER = 15
ALS_REG_PARAM = 0.09
SPLIT_SEED = 11
RMSE_GATE = 1.5
TOP_ALL = 20
TOP_SUBSET = 10

# Blocks of users and of items in training: this many at least, and more once a block would
# hold more ratings than this.
LEAST_BLOCKS = 2
BLOCK_RATINGS = 100_000_000
# Of these, as many as fill the cores with this many ratings a task, each task's cut into
# blocks of this many, which are sorted at once.
TASK_RATINGS = 50_000
SORTED_RATINGS = 2_000_000


def rating_weight(score) -> Column:
    """Low score -> high weight: <=3 -> 3, <=8 -> 2, otherwise 1 (float)."""
    s = F.col(score) if isinstance(score, str) else score
    return (F.when(s <= 3, 3).when(s <= 8, 2).otherwise(1)).cast("float")


def number_answers(answers: DataFrame, *keep: str) -> DataFrame:
    """(columns ``keep``, student_id long, question_id long, rating float) of every answer: an id
    without a number and the rating of a null score are null."""
    # Behind a generator: filters on the numbers, here or in a split, read its columns and
    # are not pushed below it with copies of the parse.
    return answers.select(*keep, F.inline(F.array(F.struct(
        id_number("student_id", "long").alias("student_id"), id_number("question_id", "long").alias("question_id"),
        F.when(F.col("score").isNotNull(), rating_weight("score")).alias("rating")))))


def rated(numbers: DataFrame) -> DataFrame:
    """(student_id, question_id, rating) of the rows of :func:`number_answers` that have all three."""
    return numbers.select("student_id", "question_id", "rating").dropna()


def extract_ratings(answers: DataFrame) -> DataFrame:
    """(student_id long, question_id long, rating float); repeats kept, rows
    with a null score or an id without a number dropped."""
    return rated(number_answers(answers.filter(F.col("score").isNotNull())))


def make_als(rank: int = ALS_RANK, max_iter: int = ALS_MAX_ITER,
             reg_param: float = ALS_REG_PARAM, seed: int = SPLIT_SEED,
             num_blocks: int | None = None, checkpoint_interval: int = 10) -> ALS:
    """Explicit-feedback ALS; the seed is always set so runs repeat."""
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg_param,
              userCol="student_id", itemCol="question_id", ratingCol="rating",
              coldStartStrategy="drop", seed=seed,
              checkpointInterval=checkpoint_interval)
    if num_blocks:
        als = als.setNumUserBlocks(num_blocks).setNumItemBlocks(num_blocks)
    return als


def _als_input(df: DataFrame) -> DataFrame:
    """Spark's ALS takes 32-bit ids; rows with a larger id are unknown to any model,
    in training as in serving, and leave here."""
    rows = df.select(F.col("student_id").try_cast("int").alias("student_id"),
                     F.col("question_id").try_cast("int").alias("question_id"),
                     F.col("rating").cast("float").alias("rating"))
    return rows.filter(F.col("student_id").isNotNull() & F.col("question_id").isNotNull())


def block_count(ratings: int, cores: int) -> int:
    """Least number of blocks for a training on ``ratings`` rows, at most one per core."""
    return max(1, min(cores, max(LEAST_BLOCKS, math.ceil(ratings / BLOCK_RATINGS))))


def part_count(ratings: int, cores: int) -> int:
    """Blocks that a training on ``ratings`` rows is dealt into: as many for each of its tasks,
    small enough that a task sorts one in memory.  In each iteration a task reads the other
    side's factors once, whatever the number of its blocks."""
    tasks = max(block_count(ratings, cores), min(cores, ratings // TASK_RATINGS))
    return tasks * max(1, math.ceil(ratings / (tasks * SORTED_RATINGS)))


def _model(als: ALS, users: DataFrame, items: DataFrame) -> ALSModel:
    """Spark's model of these factors, with the settings of ``als``."""
    made = users.sparkSession._jvm.org.apache.spark.ml.recommendation.ALSModel(als.uid, als.getRank(), users._jdf, items._jdf)
    model = als._copyValues(als._create_model(made))
    model._transfer_params_to_java()    # for its own list methods
    return model


def train(ratings: DataFrame, **kw) -> ALSModel:
    """Fit ALS, unless ``num_blocks`` is given in the blocks of :func:`part_count`.

    The solver reads its input once for each side, so the input is persisted while it does,
    on disk: nothing of it stays in the memory that the sorts need.  It is counted first, for
    the blocks.  The factors are tables in the shared folder."""
    data = _als_input(ratings).persist(StorageLevel.DISK_ONLY)
    try:
        rows = data.count()
        if not kw.get("num_blocks"):
            kw["num_blocks"] = part_count(rows, ratings.sparkSession.sparkContext.defaultParallelism)
        als = make_als(**kw)
        return _model(als, *fit(data, als.getUserCol(), als.getItemCol(), als.getRatingCol(), kw["num_blocks"], als.getRank(),
                                als.getMaxIter(), als.getRegParam(), als.getSeed()))
    finally:
        data.unpersist()


def predict(model: ALSModel, ratings: DataFrame) -> DataFrame:
    """Adds ``prediction``; unknown students/questions are dropped (cold start)."""
    return model.transform(_als_input(ratings))


def evaluate(predictions: DataFrame) -> float:
    """RMSE of ``prediction`` against ``rating`` (NaN when nothing is scored), in one pass:
    the joins with the factors are not run again to see whether there are rows."""
    error = F.col("prediction").cast("double") - F.col("rating").cast("double")
    rmse = predictions.agg(F.sqrt(F.avg(error * error)).alias("rmse")).first()["rmse"]
    return float("nan") if rmse is None else rmse


def passes_gate(rmse: float, gate: float = RMSE_GATE) -> bool:
    """``rmse <= gate``; NaN fails, as it compares false."""
    return not math.isnan(rmse) and rmse <= gate


def publish_if_good(spark: SparkSession, model: ALSModel, rmse: float,
                    model_root: str, registry_path: str,
                    model_name: str = "als_model",
                    item: str = "recommended_question_id",
                    gate: float = RMSE_GATE) -> str | None:
    """Save the model under a time-stamped path and append it to the registry
    when it passes the gate; return the path (None when refused)."""
    if not passes_gate(rmse, gate):
        return None
    path = f"{model_root.rstrip('/')}/{int(time.time() * 1000)}"
    model.write().overwrite().save(path)
    reg.publish(spark, registry_path, model_name, item, path, float(rmse))
    return path


def _lists(model: ALSModel, users: DataFrame, k: int) -> DataFrame:
    """(student_id, recommendations) as ``recommendForAllUsers`` gives them, best first and
    ties to the smaller question, for the user factors ``users``.  Spark's own method ships
    and sorts a list for every pair of factor blocks; here no pair leaves its task."""
    found = top_products(users, model.itemFactors, k)
    return found.select(F.col("id").cast("int").alias("student_id"), F.transform("best", lambda x: F.struct(
        x["id"].cast("int").alias("question_id"), x["score"].cast("float").alias("rating"))).alias("recommendations"))


def recommend_all(model: ALSModel, k: int = TOP_ALL) -> DataFrame:
    return _lists(model, model.userFactors, k)


def recommend_subset(model: ALSModel, students: DataFrame, k: int = TOP_SUBSET) -> DataFrame:
    """Top-k for the students in ``students.student_id`` (numbers); repeats
    are de-duplicated and unknown students dropped."""
    ids = students.select(F.col("student_id").try_cast("int").alias("id"))
    return _lists(model, model.userFactors.join(ids, "id", "left_semi"), k)


def recs_to_text(recs: DataFrame, student_prefix: str = STUDENT_PREFIX,
                 question_prefix: str = QUESTION_PREFIX) -> DataFrame:
    """(student_id text, recommendations "q1,q2,...") in rank order."""
    return recs.select(id_text(student_prefix, "student_id").alias("student_id"),
                       ids_to_text("recommendations", question_prefix).alias("recommendations"))


def attach_recs(answers: DataFrame, recs_text: DataFrame) -> DataFrame:
    """Answers joined with their student's recommendations (inner, USING
    student_id): answers of unknown students drop out, repeated answers repeat
    the recommendation."""
    return answers.join(recs_text, "student_id", "inner")


class ModelCache:
    """Per-batch model lookup that reloads only when the registry moved."""

    def __init__(self, spark: SparkSession, registry_path: str,
                 model_name: str = "als_model", item: str = "recommended_question_id"):
        self.spark, self.registry_path = spark, registry_path
        self.model_name, self.item = model_name, item
        self.path: str | None = None
        self.model: ALSModel | None = None
        self.loads = 0

    def current(self) -> ALSModel | None:
        path = reg.current_path(self.spark, self.registry_path, self.model_name, self.item)
        if path is None:
            return None
        if path != self.path:
            self.model, self.path = ALSModel.load(path), path
            self.loads += 1
        return self.model


class NoModel(RuntimeError):
    """No model has been published yet; the micro-batch must be tried again."""


def model_recommender(cache: ModelCache, k: int = TOP_SUBSET):
    """Students -> their top-k by the registry's current model."""
    def run(students: DataFrame) -> DataFrame:
        model = cache.current()
        if model is None:
            raise NoModel(f"no model in the registry {cache.registry_path}")
        return recommend_subset(model, students, k)
    return run


def serve_batch(recommender, output) -> callable:
    """``foreachBatch`` function: answers of the batch -> recommendations for
    their students -> text -> joined to the answers -> ``output(df, batch_id)``.

    ``recommender``: students (student_id) -> (student_id, recommendations), for
    example :func:`model_recommender`.  What it raises ends the query before the
    batch's offsets are committed, so a restart serves the same batch again.

    Empty batches and batches without any known student are skipped.  The
    batch is read twice (students, join) and the per-batch recommendations
    are checked then joined, so both are persisted for the duration of the
    batch and released afterwards.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        batch = batch.persist()
        recs = None
        try:
            students = (batch.select(id_number("student_id").alias("student_id"))
                        .filter(F.col("student_id").isNotNull()))
            recs = recs_to_text(recommender(students)).persist()
            if not recs.isEmpty():
                output(attach_recs(batch, recs), batch_id)
        finally:
            if recs is not None:
                recs.unpersist()
            batch.unpersist()
    return run


def train_evaluate_publish(spark: SparkSession, ratings: DataFrame, model_root: str,
                           registry_path: str, recs_path: str | None = None,
                           gate: float = RMSE_GATE, **als_kw) -> dict:
    """The offline job: split, fit, score the held-out part, evaluate, and
    publish the model (and optionally its top-k table) when it passes.

    Ratings and both splits are persisted while training reads them several
    times and released at the end.  Returns the RMSE, the published path (or
    None) and the split sizes.
    """
    from livetable.operators.split import hash_split
    ratings = ratings.persist()
    train_df, test_df = hash_split(ratings, ["student_id", "question_id"], 8, 10, SPLIT_SEED)
    train_df, test_df = train_df.persist(), test_df.persist()
    try:
        model = train(train_df, **als_kw)
        rmse_value = evaluate(predict(model, test_df))
        path = publish_if_good(spark, model, rmse_value, model_root, registry_path, gate=gate)
        if path and recs_path:
            recommend_all(model, TOP_ALL).write.mode("overwrite").parquet(recs_path)
        return {"rmse": rmse_value, "path": path,
                "train_rows": train_df.count(), "test_rows": test_df.count()}
    finally:
        train_df.unpersist()
        test_df.unpersist()
        ratings.unpersist()
