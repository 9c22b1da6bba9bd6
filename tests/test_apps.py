"""End-to-end applications on replayed tables."""

import os
import uuid

from pyspark.sql import functions as F

from livetable import session
from livetable.plans import apps, queries as Q, standins as st
from livetable.sources.files import read_lines, stream_table
from livetable.streaming.eventtime import windowed_count
from livetable.streaming.sinks import read_snapshot

from conftest import SF0001

AVAILABLE_NOW = {"availableNow": True}


def _run_id():
    """Apps keep fixed checkpoint folders under the session's shared folder
    (a restarted app resumes them), so every test run names its own app."""
    return uuid.uuid4().hex[:12]


def _rows(df, order):
    return [tuple(r) for r in df.select(*order).collect()]


def test_answer_stats_four_queries_and_per_batch_form(spark, tmp):
    lines = st.answer_json_lines(st.answers(spark, SF0001, stream=True))
    app = "stats_" + _run_id()
    for q in apps.answer_stats(spark, lines, app=app, trigger=AVAILABLE_NOW):
        q.awaitTermination()
    base = session.shared_dir(spark, "apps", app)
    expected = {k: Q.QUERIES[k](spark, SF0001) for k in
                ["top10_questions", "top10_grades", "top10_questions_with_subject",
                 "lowest_score_students"]}
    for k, df in expected.items():
        got = read_snapshot(spark, f"{base}/{k}/out")
        assert sorted(_rows(got, df.columns)) == sorted(_rows(df, df.columns)), k

    # One read, one parse, state merged batch by batch (several batches).
    app2 = "statsb_" + _run_id()
    src = os.path.join(tmp, "answers_json")
    st.answer_json_lines(st.answers(spark, SF0001)).repartition(3).write.text(src)
    with open(os.path.join(tmp, "bad.txt"), "w") as f:
        f.write("{broken\n")
    q = apps.answer_stats_per_batch(spark, read_lines(spark, src, stream=True, max_files_per_trigger=1),
                                    app=app2, trigger=AVAILABLE_NOW)
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 3
    base2 = session.shared_dir(spark, "apps", app2)
    for k, df in expected.items():
        got = read_snapshot(spark, f"{base2}/{k}")
        assert sorted(_rows(got, df.columns)) == sorted(_rows(df, df.columns)), k
    assert spark.read.parquet(f"{base2}/answers").count() == st.answers(spark, SF0001).count()


def test_word_count_and_windows_apps(spark, tmp):
    docs = os.path.join(tmp, "docs")
    st.doc_lines(spark, SF0001).select("value").write.text(docs)
    app = "wc_" + _run_id()
    apps.word_count(spark, read_lines(spark, docs, stream=True), app=app,
                    trigger=AVAILABLE_NOW).awaitTermination()
    got = read_snapshot(spark, session.shared_dir(spark, "apps", app, "counts", "out"))
    want = Q.QUERIES["wordcount_dsl"](spark, SF0001)
    assert sorted(_rows(got, ["word", "count"])) == sorted(_rows(want, ["word", "count"]))

    ev_lines = os.path.join(tmp, "ev")
    st.event_word_lines(stream_table(spark, SF0001, "events"))  # stream form builds
    st.event_word_lines(spark.read.parquet(f"{SF0001}/events.parquet")).write.text(ev_lines)
    app2 = "win_" + _run_id()
    for q in apps.event_windows(spark, read_lines(spark, ev_lines, stream=True), "1 hour", "30 minutes",
                                "10 minutes", "complete", app=app2, trigger=AVAILABLE_NOW):
        q.awaitTermination()
    got = read_snapshot(spark, session.shared_dir(spark, "apps", app2, "complete", "out"))
    assert got.count() > 0 and got.agg(F.sum("count")).first()[0] == 2 * spark.read.parquet(
        f"{SF0001}/events.parquet").count()


def test_train_and_serve(spark, tmp):
    app = "rec_" + _run_id()
    res = apps.train_recommender(spark, st.answers(spark, SF0001), app=app, max_iter=5)
    assert res["path"] is not None and res["rmse"] <= 1.5
    assert res["train_rows"] + res["test_rows"] == st.answers(spark, SF0001).count()
    root = session.shared_dir(spark, "apps", app)
    assert spark.read.parquet(f"{root}/recommend_all").count() > 0
    lines = st.answer_json_lines(st.answers(spark, SF0001, stream=True))
    for q in apps.serve_recommendations(spark, lines, app=app, trigger=AVAILABLE_NOW):
        q.awaitTermination()
    served = spark.read.parquet(f"{root}/served")
    assert served.count() > 0 and "recommendations" in served.columns


def test_refused_model_is_not_published(spark, tmp):
    app = "recbad_" + _run_id()
    res = apps.train_recommender(spark, st.answers(spark, SF0001), app=app, gate=0.0, max_iter=2)
    assert res["path"] is None


def test_user_dedup_both_forms(spark, tmp):
    src = os.path.join(tmp, "ue")
    st.user_event_lines(spark.read.parquet(f"{SF0001}/events.parquet")).write.text(src)
    want = sorted(_rows(Q.user_events(spark, SF0001).dropDuplicates(
        ["userID", "eventTime", "eventType"]).groupBy("userID").count(), ["userID", "count"]))
    for fn in (apps.user_dedup, apps.user_dedup_staged):
        app = fn.__name__ + "_" + _run_id()
        qs = fn(spark, read_lines(spark, src, stream=True), app=app, trigger=AVAILABLE_NOW)
        for q in (qs if isinstance(qs, list) else [qs]):
            q.awaitTermination()
        got = read_snapshot(spark, session.shared_dir(spark, "apps", app, "counts", "out"))
        assert sorted(_rows(got, ["userID", "count"])) == want and want


def test_event_windows_append_is_laid_out_per_day(spark, tmp):
    ev_lines = os.path.join(tmp, "ev")
    st.event_word_lines(spark.read.parquet(f"{SF0001}/events.parquet")).write.text(ev_lines)
    app = "win_app_" + _run_id()
    for q in apps.event_windows(spark, read_lines(spark, ev_lines, stream=True), "1 hour", "30 minutes",
                                "10 minutes", "append", app=app, trigger=AVAILABLE_NOW):
        q.awaitTermination()
    out = session.shared_dir(spark, "apps", app, "append", "out")
    got = spark.read.parquet(out)
    days = [r.window_day for r in got.select("window_day").distinct().collect()]
    assert days and all(os.path.isdir(os.path.join(out, f"window_day={d}")) for d in days)
    assert all(r.window_day == r.window_start.date() for r in got.collect())
    one = min(days)
    plan = got.filter(F.col("window_day") == F.lit(one))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters: [isnotnull(window_day" in plan
    # Append mode emits only final windows, each with its final count.
    cols = ["window_start", "window_end", "word", "count"]
    batch = windowed_count(Q.event_words(spark, SF0001), "timestamp", "word",
                           "1 hour", "30 minutes")
    assert set(_rows(got, cols)) <= set(_rows(batch, cols))


def test_device_stats_and_etl_programs(spark, tmp):
    """The IoT statistics program (SQL and DSL queries in one application)
    and the Kafka ETL program give the rows of their batch keys."""
    from livetable.functions.timefns import to_utc_instant
    from livetable.sources.kafka import kafka_rows

    iot_src = os.path.join(tmp, "iot")
    st.iot_lines(spark.read.parquet(f"{SF0001}/events.parquet")).write.text(iot_src)
    app = "iot_" + _run_id()
    qs = apps.device_stats(spark, read_lines(spark, iot_src, stream=True), app=app,
                           trigger=AVAILABLE_NOW)
    assert len(qs) == 2
    for q in qs:
        q.awaitTermination()
    for form in ("sql", "dsl"):
        want = Q.QUERIES[f"iot_stats_{form}"](spark, SF0001)
        got = read_snapshot(spark, session.shared_dir(spark, "apps", app, form, "out"))
        assert sorted(_rows(got, want.columns)) == sorted(_rows(want, want.columns)), form

    ev = stream_table(spark, SF0001, "events")
    records = kafka_rows(ev, st.call_log_line(), "stationTopic", F.col("event_id"),
                         to_utc_instant("ts"))
    app2 = "etl_" + _run_id()
    apps.etl_filter(spark, records, "error", app=app2, trigger=AVAILABLE_NOW).awaitTermination()
    got = spark.read.parquet(session.shared_dir(spark, "apps", app2, "filtered", "out"))
    want = Q.QUERIES["etl_contains_filter"](spark, SF0001)
    assert sorted(_rows(got, ["value"])) == sorted(_rows(want, ["value"])) and want.count() > 0
