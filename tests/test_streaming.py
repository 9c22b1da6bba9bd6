"""Structured Streaming behaviour: late data, output modes, triggers,
checkpoints, idempotent sinks, batch = stream."""

import os
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from livetable.functions.text import split_words
from livetable.functions.timefns import parse_event_line
from livetable.operators.aggregate import count_by
from livetable.plans import queries as Q
from livetable.sources.files import read_lines, read_table, stream_table
from livetable.sources.generators import read_rate
from livetable.streaming.eventtime import dedup_counts, windowed_count
from livetable.streaming.sinks import (dropped_by_watermark, foreach_batch_outputs, latest_updates, list_versions,
                                       read_snapshot, run_available_now, snapshot_path_writer,
                                       start_query, updates_path_writer)

from conftest import SF0001

# Late data, worked out by hand: windows of 20 s every 10 s, watermark 15 s, all times
# 2024-05-05 18:mm:ss.  Each step is one micro-batch and the no-data batch after it.
STEPS = [["40:12,kite", "40:31,sail", "40:18,kite"],    # watermark then 40:16
         ["40:05,oar", "40:44,kite"],                   # 40:05 is late for one of its windows; 40:29
         ["40:09,oar", "40:52,sail"],                   # 40:09 is too late for both; 40:37
         ["41:10,oar"],                                 # 40:55
         ["40:40,sail"]]                                # late for the window that ends 40:50


def _clock(seconds):
    return f"{seconds // 60:02d}:{seconds % 60:02d}"


def _counts(*rows):
    """(start, word, count) with the start in seconds after 18:40:00."""
    return sorted((_clock(2400 + start), _clock(2420 + start), word, n) for start, word, n in rows)


@pytest.fixture(autouse=True)
def fresh_streams(spark):
    """Queries of other tests that ended, failed ones too, are not waited for here."""
    spark.streams.resetTerminated()


def _run_steps(spark, tmp, mode):
    src, seen, out = os.path.join(tmp, "lines"), [], []
    os.makedirs(src)
    at, word = parse_event_line("value")
    rows = read_lines(spark, src, stream=True).select(at.alias("at"), word.alias("word"))

    def note(batch, _):
        seen.extend((r["window_start"].strftime("%M:%S"), r["window_end"].strftime("%M:%S"), r["word"], r["count"])
                    for r in batch.collect())

    q = start_query(windowed_count(rows, "at", "word", "20 seconds", "10 seconds", "15 seconds"), "foreach_batch",
                    os.path.join(tmp, "ck"), mode, batch_fn=note)
    try:
        for k, step in enumerate(STEPS):
            draft = os.path.join(tmp, f"{k}.txt")
            with open(draft, "w") as f:
                f.writelines(f"2024-05-05 18:{line}\n" for line in step)
            os.rename(draft, os.path.join(src, f"{k}.txt"))
            q.processAllAvailable()
            time.sleep(1.5)  # the no-data batch applies the new watermark
            q.processAllAvailable()
            out.append(sorted(seen))
            seen.clear()
        return out, dropped_by_watermark(q)
    finally:
        q.stop()


def test_late_data_update_mode(spark, tmp):
    out, dropped = _run_steps(spark, tmp, "update")
    assert out == [_counts((0, "kite", 2), (10, "kite", 2), (20, "sail", 1), (30, "sail", 1)),
                   _counts((0, "oar", 1), (30, "kite", 1), (40, "kite", 1)),
                   _counts((40, "sail", 1), (50, "sail", 1)),
                   _counts((60, "oar", 1), (70, "oar", 1)),
                   _counts((40, "sail", 2))]
    assert dropped == 4     # (row, window) pairs


def test_late_data_append_mode(spark, tmp):
    out, dropped = _run_steps(spark, tmp, "append")
    assert out == [[], _counts((0, "kite", 2), (0, "oar", 1)), _counts((10, "kite", 2)),
                   _counts((20, "sail", 1), (30, "sail", 1), (30, "kite", 1)), []]
    assert dropped == 4


def test_output_mode_refusals(spark, tmp):
    lines = read_lines(spark, tmp, stream=True)
    counts = count_by(split_words(lines), "word")
    with pytest.raises(AnalysisException):  # append + aggregation, no watermark
        start_query(counts, "noop", os.path.join(tmp, "c1"), "append")
    with pytest.raises(AnalysisException):  # update + sort
        start_query(counts.orderBy("count"), "noop", os.path.join(tmp, "c2"), "update")
    with pytest.raises(AnalysisException):  # complete without aggregation
        start_query(split_words(lines), "noop", os.path.join(tmp, "c3"), "complete")


def test_continuous_trigger_map_only(spark, tmp):
    rate = read_rate(spark, rows_per_second=50, num_partitions=2)
    agg = rate.groupBy((F.col("value") % 2).alias("k")).count()
    with pytest.raises(Exception, match="(?i)continuous"):
        q = start_query(agg, "memory", os.path.join(tmp, "c1"), "complete",
                        query_name="t_cont_agg", trigger={"continuous": "1 second"})
        q.awaitTermination(10)
        raise RuntimeError("continuous aggregation was accepted")
    mapped = rate.select((F.col("value") * 2).alias("v"))
    q = start_query(mapped, "memory", os.path.join(tmp, "c2"), "append",
                    query_name="t_cont_map", trigger={"continuous": "1 second"})
    try:
        deadline = time.time() + 30
        while time.time() < deadline and spark.table("t_cont_map").count() == 0:
            time.sleep(0.5)
    finally:
        q.stop()
    assert spark.table("t_cont_map").filter(F.col("v") % 2 == 1).count() == 0
    assert spark.table("t_cont_map").count() > 0


def test_rate_micro_batch_source(spark, tmp):
    rate = read_rate(spark, micro_batch=True, rows_per_batch=10, num_partitions=2)
    q = start_query(rate, "memory", os.path.join(tmp, "ck"), "append", query_name="t_rate")
    try:
        deadline = time.time() + 30
        while time.time() < deadline and len(q.recentProgress) < 2:
            time.sleep(0.2)
    finally:
        q.stop()
    n = spark.table("t_rate").count()
    assert n >= 10 and n % 10 == 0


def test_checkpoint_restart_keeps_state(spark, tmp):
    src, ck, out = (os.path.join(tmp, x) for x in ("in", "ck", "out"))
    os.makedirs(src)

    def run():
        counts = count_by(split_words(read_lines(spark, src, stream=True)), "word")
        run_available_now(counts, "snapshot", ck, "complete", path=out)
        return {r["word"]: r["count"] for r in read_snapshot(spark, out).collect()}

    with open(os.path.join(src, "1.txt"), "w") as f:
        f.write("hello me you her\nhello her\n")
    assert run() == {"hello": 2, "me": 1, "you": 1, "her": 2}
    with open(os.path.join(src, "2.txt"), "w") as f:
        f.write("hello you\n")
    assert run() == {"hello": 3, "me": 1, "you": 2, "her": 2}
    assert run() == {"hello": 3, "me": 1, "you": 2, "her": 2}  # nothing new


def test_sinks_are_idempotent_on_replay(spark, tmp):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    up, snap = os.path.join(tmp, "up"), os.path.join(tmp, "snap")
    w_up, w_snap = updates_path_writer(up), snapshot_path_writer(snap)
    for _ in range(2):  # the second call is a replay of batch 0
        w_up(df, 0)
        w_snap(df, 0)
    w_up(spark.createDataFrame([("a", 5)], "k string, v int"), 1)
    assert read_snapshot(spark, snap).count() == 2
    assert spark.read.parquet(up).count() == 3
    # Snapshot versions: the newest committed one is read; the committed one
    # before it stays for readers still on it; older ones are removed.
    w_snap(spark.createDataFrame([("c", 3)], "k string, v int"), 1)
    assert [r.k for r in read_snapshot(spark, snap).collect()] == ["c"]
    assert list_versions(spark, snap) == [0, 1]
    w_snap(spark.createDataFrame([("d", 4)], "k string, v int"), 2)
    assert list_versions(spark, snap, committed=True) == [1, 2]
    latest = {r["k"]: r["v"] for r in latest_updates(spark, up, ["k"], ["v"]).collect()}
    assert latest == {"a": 5, "b": 2}


def test_foreach_batch_outputs(spark, tmp):
    calls = []
    fn = foreach_batch_outputs([lambda b, i: calls.append(("one", i, b.count())),
                                lambda b, i: calls.append(("two", i, b.count()))])
    fn(spark.createDataFrame([], "k string"), 0)
    fn(spark.createDataFrame([("x",)], "k string"), 1)
    assert calls == [("one", 1, 1), ("two", 1, 1)]


def test_many_queries_one_application(spark, tmp):
    ev = stream_table(spark, SF0001, "events")
    q1 = start_query(count_by(ev, "event_type"), "memory", os.path.join(tmp, "a"),
                     "complete", query_name="t_q1", trigger={"availableNow": True})
    q2 = start_query(count_by(ev, "user_id"), "memory", os.path.join(tmp, "b"),
                     "complete", query_name="t_q2", trigger={"availableNow": True})
    spark.streams.awaitAnyTermination(120)
    q1.awaitTermination(120)
    q2.awaitTermination(120)
    assert spark.table("t_q1").count() == 5
    assert spark.table("t_q2").count() == read_table(spark, SF0001, "events") \
        .select("user_id").distinct().count()


def test_batch_equals_stream(spark, tmp):
    def windows(stream):
        return Q.event_words(spark, SF0001, stream)

    batch = windowed_count(windows(False), "timestamp", "word", "1 hour", "30 minutes")
    stream = windowed_count(windows(True), "timestamp", "word", "1 hour", "30 minutes",
                            watermark="10 minutes")
    run_available_now(stream, "snapshot", os.path.join(tmp, "ck"), "complete",
                      path=os.path.join(tmp, "out"))
    a = sorted(tuple(r) for r in batch.collect())
    b = sorted(tuple(r) for r in read_snapshot(spark, os.path.join(tmp, "out"))
               .select(*batch.columns).collect())
    assert a == b and len(a) > 0

    ue_b = dedup_counts(Q.user_events(spark, SF0001), ["userID", "eventTime", "eventType"], "userID")
    ue_s = dedup_counts(Q.user_events(spark, SF0001, stream=True),
                        ["userID", "eventTime", "eventType"], "userID")
    run_available_now(ue_s, "snapshot", os.path.join(tmp, "ck2"), "complete",
                      path=os.path.join(tmp, "out2"))
    assert sorted(map(tuple, ue_b.collect())) == \
        sorted(map(tuple, read_snapshot(spark, os.path.join(tmp, "out2")).collect()))


def test_console_sink_and_fixed_interval_trigger(spark, tmp, capfd):
    ev = stream_table(spark, SF0001, "events")
    q = start_query(count_by(ev, "event_type"), "console", os.path.join(tmp, "c"),
                    "complete", options={"truncate": "false"}, trigger={"availableNow": True})
    q.awaitTermination(120)
    src = os.path.join(tmp, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("a b a\n")
    q2 = start_query(count_by(split_words(read_lines(spark, src, stream=True)), "word"),
                     "memory", os.path.join(tmp, "p"), "complete", query_name="t_fixed",
                     trigger={"processingTime": "1 second"})
    try:
        q2.processAllAvailable()
        assert {r.word: r["count"] for r in spark.table("t_fixed").collect()} == {"a": 2, "b": 1}
        assert q2.status["isTriggerActive"] in (True, False)
    finally:
        q2.stop()


def test_stream_static_join_both_paths(spark):
    """Broadcast and shuffle join give the oracle's rows."""
    from livetable.plans.oracle import ORACLE
    from oracle_compare import compare

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for limit in (old, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            r = compare(spark, "stream_static_join", Q.q_stream_static_join, ORACLE["stream_static_join"], SF0001)
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        assert r["cols_match"] and r["values_match"], (limit, r)
        assert r["spark_rows"] == r["oracle_rows"] > 0


def test_small_static_side_does_not_shuffle_the_stream(spark, tmp):
    """No hint and no round robin: Spark broadcasts what its own bound allows."""
    from livetable.plans import standins as st
    _, q = st.start_answer_topic(spark, SF0001, os.path.join(tmp, "topic"), {"availableNow": True})
    q.awaitTermination()
    plan = q._jsq.streamingQuery().lastExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("BroadcastHashJoin") == 2, plan  # orders, part
    assert "Exchange hashpartitioning" not in final and "RoundRobin" not in final, plan


def test_late_rows_of_an_ordered_replay_are_an_error(spark, tmp):
    """A replay that is not in time order is refused, not cut."""
    from livetable.streaming.eventtime import run_in_time_order
    rows = [(f"2023-01-{d:02d} 00:00:00", "x") for d in (20, 1)]
    df = spark.createDataFrame(rows, "t string, word string").selectExpr("cast(t as timestamp_ntz) ts", "word")

    def run(stream):
        counts = windowed_count(stream, "ts", "word", "1 hour", "30 minutes", "10 minutes")
        return run_available_now(counts, "parquet", os.path.join(tmp, "ck"), "append", path=os.path.join(tmp, "out"))

    run_in_time_order(spark, df, "ts", os.path.join(tmp, "in"), 2, run)
    df.filter("ts < '2023-01-02'").write.mode("append").parquet(os.path.join(tmp, "in"))
    assert dropped_by_watermark(run(spark.readStream.schema(df.schema).parquet(os.path.join(tmp, "in")))) > 0
