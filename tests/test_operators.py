"""Operators on small frames: missing ids, aggregates, ranking, joins."""

from pyspark.sql import functions as F

from livetable.operators.aggregate import (count_by, filtered_stats, lowest_by,
                                           rmse, rmse_vs_group_mean, top_n_with_attr)
from livetable.operators.integrity import missing_id_xor, missing_ids
from livetable.operators.joins import attach
from livetable.operators.ranking import lowest_items_per_key


def test_missing_single_id_by_xor(spark):
    for n, gone in [(10, 7), (1000, 1), (1001, 500), (12, 12), (4, 2)]:
        df = spark.range(1, n + 1).filter(F.col("id") != gone)
        r = missing_id_xor(df, "id", 1, n).first()
        assert (r.n_missing, r.missing_id) == (1, gone)


def test_missing_none_and_many(spark):
    r = missing_id_xor(spark.range(5, 50), "id").first()
    assert (r.lo, r.hi, r.n_missing, r.xor_missing, r.missing_id) == (5, 49, 0, 0, None)
    df = spark.createDataFrame([(1,), (2,), (2,), (5,), (None,)], "id long")
    r = missing_id_xor(df, "id").first()
    assert (r.n_missing, r.xor_missing, r.missing_id) == (2, 3 ^ 4, None)
    got = sorted(x[0] for x in missing_ids(spark, df, "id", 0, 6).collect())
    assert got == [0, 3, 4, 6]


def test_iot_count_forms(spark):
    df = spark.createDataFrame([("a", "t", 40.0), (None, "t", 50.0), ("c", "t", 10.0),
                                ("d", "u", None)], "device_id string, deviceType string, signal double")
    sql_form = filtered_stats(df, F.col("signal") > 30, "deviceType", "signal").collect()
    dsl_form = filtered_stats(df, F.col("signal") > 30, "deviceType", "signal",
                              count_col="device_id").collect()
    assert [(r.deviceType, r.counts, r.mean_signal) for r in sql_form] == [("t", 2, 45.0)]
    assert [(r.deviceType, r.counts) for r in dsl_form] == [("t", 1)]  # null id skipped


def test_top_with_attr_and_lowest(spark):
    df = spark.createDataFrame([("s1", "q1", "x", 5), ("s1", "q2", "x", 2), ("s2", "q1", "x", 2),
                                ("s2", "q3", "y", 2), ("s3", "q3", "y", None)],
                               "student_id string, question_id string, subject_id string, score int")
    top = top_n_with_attr(df, "question_id", "subject_id", 2).collect()
    assert [(r.question_id, r.subject_id, r["count"]) for r in top] == [("q1", "x", 2), ("q3", "y", 2)]
    low = lowest_by(df, "student_id", "score", "question_id", 10).collect()
    assert [(r.student_id, r.minscore, r.question_id) for r in low] == \
        [("s1", 2, "q2"), ("s2", 2, "q1")]
    per = lowest_items_per_key(df, "student_id", "question_id", "score", k=1).collect()
    assert sorted((r.student_id, r.question_id) for r in per) == [("s1", "q2"), ("s2", "q1")]


def test_rmse_forms_agree(spark):
    df = spark.createDataFrame([(g, float(x)) for g, x in
                                [("a", 1), ("a", 3), ("b", 2), ("b", 2), ("b", 5)]], "g string, x double")
    means = df.groupBy("g").agg(F.avg("x").alias("m"))
    direct = rmse(df.join(means, "g"), "x", "m").first()
    fast = rmse_vs_group_mean(df, "g", "x", digits=None).first()
    assert abs(direct.rmse - fast.rmse) < 1e-12 and direct.n == fast.n == 5


def test_attach_leaves_the_join_choice_to_spark(spark):
    big = spark.range(0, 100000).withColumnRenamed("id", "k")
    small = spark.range(0, 10).withColumnRenamed("id", "k")
    j = attach(big, small, "k")
    assert "BroadcastHashJoin" in j._jdf.queryExecution().executedPlan().toString()
    assert "ResolvedHint" not in j._jdf.queryExecution().analyzed().toString()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = attach(big, small, "k")
        assert "SortMergeJoin" in j._jdf.queryExecution().executedPlan().toString()
        assert j.count() == 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_group_rmse_keeps_its_digits_for_large_means(spark):
    df = spark.createDataFrame([("a", 1e9 + x) for x in (0.0, 1.0, 2.0, 3.0)], "g string, x double")
    r = rmse_vs_group_mean(df, "g", "x", digits=None).first()
    assert abs(r.rmse - 1.25 ** 0.5) < 1e-9


def test_count_by_named(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "w string")
    got = {r.w: r.n for r in count_by(df, "w", "n").collect()}
    assert got == {"a": 2, None: 1}
