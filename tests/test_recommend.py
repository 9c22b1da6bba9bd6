"""ALS training, gate, registry, subset scoring and per-batch serving."""

import math
import os

import pytest
from pyspark.sql import functions as F

from livetable.operators import recommend as rec
from livetable.operators import registry as reg
from livetable.operators.split import hash_split
from livetable.plans import standins as st
from livetable.streaming.sinks import run_available_now

from conftest import SF0001


@pytest.fixture(scope="module")
def trained(spark):
    ratings = rec.extract_ratings(st.answers(spark, SF0001)).persist()
    train, test = hash_split(ratings, ["student_id", "question_id"])
    model = rec.train(train, max_iter=5)
    yield ratings, train, test, model
    ratings.unpersist()


def test_rating_weight(spark):
    df = spark.createDataFrame([(s,) for s in [0, 3, 4, 8, 9, 11, None]], "score int")
    got = [r[0] for r in df.select(rec.rating_weight("score")).collect()]
    assert got == [3.0, 3.0, 2.0, 2.0, 1.0, 1.0, 1.0]


def test_extract_ratings_drops_null_score_and_bad_ids(spark):
    df = spark.createDataFrame([("学生ID_1", "题目ID_2", 2), ("学生ID_1", "题目ID_2", 2),
                                ("学生ID_x", "题目ID_2", 5), ("学生ID_3", "题目ID_4", None)],
                               "student_id string, question_id string, score int")
    got = [tuple(r) for r in rec.extract_ratings(df).collect()]
    assert got == [(1, 2, 3.0), (1, 2, 3.0)]  # repeats kept


def test_ratings_are_parsed_once_a_row(spark):
    """Filters on the numbers hold no copies of the parse."""
    df = spark.range(3).selectExpr("concat('s_', id) as student_id", "concat('q_', id) as question_id", "cast(id as int) as score")
    train, _ = hash_split(rec.extract_ratings(df), ["student_id", "question_id"])
    assert str(train._jdf.queryExecution().optimizedPlan()).lower().count("stringsplitsql") == 2


def test_evaluation_reads_the_predictions_once(spark, monkeypatch):
    """No look at the rows, which runs the joins with the factors, comes before the sum."""
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 1.0), (2.0, 1.0), (3.0, 1.0)], "prediction double, rating float")
    for look in ("isEmpty", "count"):
        monkeypatch.setattr(type(df), look, lambda *_: pytest.fail("the predictions are read twice"))
    assert rec.evaluate(df) == math.sqrt((1 + 0 + 1 + 4) / 4)


def test_hash_split_is_stable_and_disjoint(trained):
    ratings, train, test, _ = trained
    assert train.count() + test.count() == ratings.count()
    assert 0.7 < train.count() / ratings.count() < 0.9
    a = sorted(map(tuple, test.collect()))
    b = sorted(map(tuple, hash_split(ratings.repartition(7), ["student_id", "question_id"])[1].collect()))
    assert a == b  # independent of partitioning


def test_predict_cold_start_drop_and_rmse(spark, trained):
    _, train, test, model = trained
    pred = rec.predict(model, test)
    assert set(pred.columns) >= {"student_id", "question_id", "rating", "prediction"}
    assert pred.filter(F.isnan("prediction")).count() == 0
    assert pred.count() <= test.count()
    unknown = spark.createDataFrame([(10 ** 8, 1, 1.0)], "student_id long, question_id long, rating float")
    assert rec.predict(model, unknown).count() == 0
    r = rec.evaluate(pred)
    assert r > 0 and not math.isnan(r)
    assert math.isnan(rec.evaluate(rec.predict(model, unknown)))


def test_gate():
    assert rec.passes_gate(1.5) and rec.passes_gate(0.3)
    assert not rec.passes_gate(1.5001)
    assert not rec.passes_gate(float("nan"))


def test_seed_repeatability(trained):
    _, train, test, model = trained
    again = rec.train(train, max_iter=5)
    a = sorted((r.student_id, r.question_id, round(r.prediction, 5))
               for r in rec.predict(model, test).collect())
    b = sorted((r.student_id, r.question_id, round(r.prediction, 5))
               for r in rec.predict(again, test).collect())
    assert a == b


def test_recommend_all_and_subset(spark, trained):
    _, train, _, model = trained
    allr = rec.recommend_all(model, 20)
    assert allr.count() == train.select("student_id").distinct().count()
    for row in allr.limit(20).collect():
        ratings = [x.rating for x in row.recommendations]
        assert len(ratings) <= 20 and ratings == sorted(ratings, reverse=True)
    some = train.select("student_id").limit(1).first()[0]
    users = spark.createDataFrame([(some,), (some,), (999999,)], "student_id long")
    sub = rec.recommend_subset(model, users, 10).collect()
    assert len(sub) == 1 and sub[0].student_id == some and len(sub[0].recommendations) <= 10


def test_publish_registry_and_reload(spark, trained, tmp):
    _, _, test, model = trained
    root, registry = os.path.join(tmp, "models"), os.path.join(tmp, "registry")
    assert rec.publish_if_good(spark, model, float("nan"), root, registry) is None
    assert reg.current_path(spark, registry, "als_model", "recommended_question_id") is None
    p1 = rec.publish_if_good(spark, model, 1.0, root, registry)
    assert p1 and reg.current_path(spark, registry, "als_model", "recommended_question_id") == p1
    cache = rec.ModelCache(spark, registry)
    m = cache.current()
    a = sorted((r.student_id, r.question_id, round(r.prediction, 5)) for r in rec.predict(model, test).collect())
    b = sorted((r.student_id, r.question_id, round(r.prediction, 5)) for r in rec.predict(m, test).collect())
    assert a == b  # save/load keeps the model
    cache.current()
    assert cache.loads == 1  # unchanged registry: no reload
    import time
    time.sleep(0.01)
    p2 = rec.publish_if_good(spark, model, 0.9, root, registry)
    cache.current()
    assert cache.loads == 2 and cache.path == p2


def test_latest_per_key_tie_break(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("m", "i", "p1", t), ("m", "i", "p2", t),
                                ("m", "i", "p0", t - dt.timedelta(1))],
                               "model string, item string, path string, created_at timestamp_ntz")
    r = reg.latest_per_key(df, ["model", "item"], "created_at", "path").first()
    assert r.path == "p2"


def test_latest_per_key_without_order(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("m", "a", "p1", None, 1.0), ("m", "a", "p2", None, 2.0), ("m", "b", "p3", None, 3.0),
                                ("m", "b", "p0", t, 4.0), (None, "c", "p4", None, 5.0)],
                               "model string, item string, path string, created_at timestamp_ntz, rmse double")
    got = reg.latest_per_key(df, ["model", "item"], "created_at", "path", extra=["rmse"])
    assert {(r.model, r.item, r.path, r.created_at, r.rmse) for r in got.collect()} == {
        ("m", "a", "p2", None, 2.0), ("m", "b", "p0", t, 4.0), (None, "c", "p4", None, 5.0)}


def test_serve_batch_stream(spark, trained, tmp):
    _, _, _, model = trained
    root, registry = os.path.join(tmp, "models"), os.path.join(tmp, "registry")
    rec.publish_if_good(spark, model, 1.0, root, registry)
    out = os.path.join(tmp, "served")

    def write(df, batch_id):
        df.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(out)

    answers = st.answers(spark, SF0001, stream=True)
    fn = rec.serve_batch(rec.model_recommender(rec.ModelCache(spark, registry)), write)
    run_available_now(answers, "foreach_batch", os.path.join(tmp, "ck"), batch_fn=fn)
    served = spark.read.parquet(out)
    assert served.count() > 0
    assert set(served.columns) >= {"student_id", "question_id", "recommendations"}
    row = served.first()
    assert all(x.startswith(rec.QUESTION_PREFIX) for x in row.recommendations.split(","))


def test_answers_read_before_the_first_publication_are_served_after_it(spark, trained, tmp):
    """Without a model the batch fails, its offsets stay open, and a restart serves it."""
    _, _, _, model = trained
    root, registry = os.path.join(tmp, "models"), os.path.join(tmp, "registry")
    out = os.path.join(tmp, "served")

    def write(df, batch_id):
        df.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(out)

    topic, q = st.start_answer_topic(spark, SF0001, os.path.join(tmp, "answers"), {"availableNow": True})
    q.awaitTermination()

    def serve():
        fn = rec.serve_batch(rec.model_recommender(rec.ModelCache(spark, registry)), write)
        run_available_now(st.read_answer_topic(spark, SF0001, topic), "foreach_batch", os.path.join(tmp, "ck"), batch_fn=fn)

    with pytest.raises(Exception, match="no model in the registry"):
        serve()
    assert not os.path.exists(out)
    rec.publish_if_good(spark, model, 1.0, root, registry)
    serve()
    known = {f"{rec.STUDENT_PREFIX}{r.id}" for r in model.userFactors.select("id").collect()}
    want = sum(r.student_id in known for r in st.answers(spark, SF0001).select("student_id").collect())
    assert spark.read.parquet(out).count() == want > 0


def test_unreadable_registry_is_an_error(spark, tmp):
    os.makedirs(os.path.join(tmp, "registry"))
    with open(os.path.join(tmp, "registry", "part-0.parquet"), "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        reg.current_path(spark, os.path.join(tmp, "registry"), "m", "i")
    assert reg.current_path(spark, os.path.join(tmp, "absent"), "m", "i") is None


def test_ids_beyond_32_bits_are_left_out_by_rule(spark):
    rows = spark.createDataFrame([(1, 2, 3.0), (2**31, 2, 3.0)], "student_id long, question_id long, rating float")
    assert rec._als_input(rows).count() == 1


def test_blocks_follow_the_ratings_not_the_cores(spark):
    """Each iteration sends every factor to nearly every block."""
    assert spark.sparkContext.defaultParallelism > 2
    rows = spark.range(400).selectExpr("id % 40 as student_id", "id % 37 as question_id", "cast(1 + id % 3 as float) as rating")
    model = rec.train(rows, rank=2, max_iter=1)
    assert model.userFactors.rdd.getNumPartitions() == model.itemFactors.rdd.getNumPartitions() == 2
    assert (model.userFactors.count(), model.itemFactors.count()) == (40, 37)
    assert [rec.block_count(n, 12) for n in (0, 10 ** 6, 2 * 10 ** 8, 2 * 10 ** 8 + 1, 10 ** 12)] == [2, 2, 2, 3, 12]
    assert rec.block_count(10 ** 6, 1) == 1
