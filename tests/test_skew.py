"""Hot keys: one student or one group of copies holding a third of all rows.

Results must stay whole and exact; the plans must split or pre-reduce the hot
group instead of sending it to one task.
"""

import os
from contextlib import contextmanager

from pyspark.sql import functions as F

from livetable.operators.joins import attach
from livetable.operators.ranking import lowest_items_per_key
from livetable.streaming.dedup import read_batch_distinct, start_batch_distinct
from livetable.streaming.eventtime import dedup_counts
from livetable.streaming.joins import read_join_output, start_stream_static_join
from livetable.streaming.sinks import read_snapshot, run_available_now, start_query, wait_query

HOT = "学生ID_1"


def _answers(spark, n=30000):
    """n answers; a third belong to one student, the rest spread over 1000."""
    ids = spark.range(n)
    student = F.when(F.col("id") % 3 == 0, F.lit(HOT)).otherwise(
        F.concat(F.lit("学生ID_"), (F.col("id") % 1000 + 2).cast("string")))
    return ids.select(student.alias("student_id"),
                      F.concat(F.lit("题目ID_"), (F.col("id") % 97).cast("string")).alias("question_id"),
                      (F.col("id") % 11).cast("int").alias("score"))


# Small thresholds so that AQE's skew rules fire on test-sized data.
SKEW_CONF = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@contextmanager
def _skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _recs(spark, answers, path):
    (answers.select("student_id").distinct()
     .withColumn("recommendations", F.concat(F.col("student_id"), F.lit(":r")))
     .write.parquet(path))
    return spark.read.parquet(path)


def _check_join(rows):
    assert len(rows) == 30000 and sum(r.student_id == HOT for r in rows) == 10000
    assert all(r.recommendations == r.student_id + ":r" for r in rows)


def _is_skew_split(plan):
    final = plan.split("== Initial Plan ==")[0]
    return "SortMergeJoin(skew=true)" in final and "AQEShuffleRead skewed" in final


def test_hot_student_join_is_split_by_aqe(spark, tmp):
    answers = _answers(spark)
    recs = _recs(spark, answers, os.path.join(tmp, "recs"))
    with _skew_conf(spark):
        j = attach(answers, recs, "student_id")
        rows = j.collect()
        plan = j._jdf.queryExecution().executedPlan().toString()
    _check_join(rows)
    assert _is_skew_split(plan), plan


def test_hot_student_stream_join_is_split_by_aqe(spark, tmp):
    """A stateless streaming micro-batch is planned adaptively in Spark 4.1."""
    answers = _answers(spark)
    answers.write.parquet(os.path.join(tmp, "answers"))
    recs = _recs(spark, answers, os.path.join(tmp, "recs"))
    stream = spark.readStream.schema(answers.schema).parquet(os.path.join(tmp, "answers"))
    with _skew_conf(spark):
        q = wait_query(start_stream_static_join(
            stream, recs, "student_id", os.path.join(tmp, "out"), os.path.join(tmp, "ck"),
            trigger={"availableNow": True}))
        plan = q._jsq.streamingQuery().lastExecution().executedPlan().toString()
    _check_join(read_join_output(spark, os.path.join(tmp, "out")).collect())
    assert _is_skew_split(plan), plan


def test_hot_student_top_k_is_limited_map_side(spark):
    top = lowest_items_per_key(_answers(spark), "student_id", "question_id", "score", k=10)
    rows = top.filter(F.col("student_id") == HOT).orderBy("rank").collect()
    assert len(rows) == 10 and [r["rank"] for r in rows] == list(range(1, 11))
    # Lowest score of the hot student is 0, on the questions with id % 11 == 0.
    assert rows[0]["score"] == 0
    plan = top._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_staged_dedup_with_hot_group_and_replay(spark, tmp):
    """Several micro-batches; a third of all rows are copies of one key.
    Stage 1 keeps one row per key per batch; a replayed stage-1 batch (a
    second append) leaves the final counts unchanged."""
    src = os.path.join(tmp, "in")
    schema = "userID string, eventTime string, eventType string"
    for i in range(3):
        rows = [("u_hot", "2024-01-01", "click")] * 400 + \
               [(f"u{j % 50}", f"2024-01-0{1 + j % 3}", "view") for j in range(i * 800, i * 800 + 800)]
        spark.createDataFrame(rows, schema).write.mode("overwrite").json(os.path.join(src, f"b{i}"))
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").json(src))
    keys = ["userID", "eventTime", "eventType"]
    distinct = os.path.join(tmp, "distinct")
    wait_query(start_batch_distinct(stream, keys, distinct, os.path.join(tmp, "ck1"),
                                    trigger={"availableNow": True}))
    stage1 = spark.read.parquet(distinct)
    batches = stage1.select("batch_id").distinct().count()
    hot = stage1.filter(F.col("userID") == "u_hot").groupBy("batch_id").count().collect()
    # Several batches; the hot key reaches stage 2 at most once per batch
    # (its 1,200 copies are collapsed map-side).
    assert batches > 1 and hot and all(r["count"] == 1 for r in hot)
    assert stage1.count() == stage1.select(*keys, "batch_id").distinct().count()

    # Replay: a retried batch 1 appends its keys a second time.
    stage1.filter(F.col("batch_id") == 1).write.mode("append").partitionBy("batch_id").parquet(distinct)
    staged = dedup_counts(read_batch_distinct(spark, distinct, stream, keys), keys, "userID")
    run_available_now(staged, "snapshot", os.path.join(tmp, "ck2"), "complete",
                      path=os.path.join(tmp, "out"))
    direct = dedup_counts(spark.read.schema(schema).option("recursiveFileLookup", "true")
                          .json(src), keys, "userID")
    got = sorted(map(tuple, read_snapshot(spark, os.path.join(tmp, "out")).collect()))
    assert got == sorted(map(tuple, direct.collect()))
    assert dict(got)["u_hot"] == 1


def test_staged_dedup_live_start_order(spark, tmp):
    """Stage 2 may start before stage 1 has written anything."""
    src = os.path.join(tmp, "in")
    os.makedirs(src)
    schema = "userID string, eventTime string, eventType string"
    stream = spark.readStream.schema(schema).json(src)
    keys = ["userID", "eventTime", "eventType"]
    distinct = os.path.join(tmp, "distinct")
    q2 = start_query(dedup_counts(read_batch_distinct(spark, distinct, stream, keys), keys,
                                  "userID"),
                     "memory", os.path.join(tmp, "ck2"), "complete", query_name="staged_live")
    q1 = start_batch_distinct(stream, keys, distinct, os.path.join(tmp, "ck1"))
    try:
        rows = [("u1", "d1", "a")] * 50 + [("u1", "d2", "a"), ("u2", "d1", "b")]
        spark.createDataFrame(rows, schema).write.mode("append").json(src)
        q1.processAllAvailable()
        q2.processAllAvailable()
        got = {r.userID: r["count"] for r in spark.table("staged_live").collect()}
        assert got == {"u1": 2, "u2": 1}
    finally:
        q1.stop()
        q2.stop()


def test_repeated_id_collapses_before_anti_join(spark):
    """A third of the rows repeat one id; missing ids stay exact and the
    de-duplication reuses the join's shuffle (one exchange per side)."""
    from livetable.operators.integrity import missing_ids
    ids = spark.range(1, 20001).filter(F.col("id") % 97 != 0) \
        .unionByName(spark.range(10000).select(F.lit(5).cast("long").alias("id")))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        res = missing_ids(spark, ids, "id", 1, 20000)
        got = sorted(r.missing_id for r in res.collect())
        plan = res._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == list(range(97, 20001, 97))
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 2, plan
