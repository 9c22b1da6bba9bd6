"""The topic source and the two-phase sink: offsets, admission, restarts, lost tasks, replays."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from livetable.sources import topic as tp
from livetable.streaming import committed as cm
from livetable.streaming.sinks import run_available_now, start_query


def records(spark, lo, hi, partitions=3):
    return spark.range(lo, hi).select(
        F.lit(None).cast("binary").alias("key"), F.encode(F.col("id").cast("string"), "UTF-8").alias("value"),
        # A third of the offsets and more lie in partition 0.
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.pmod(F.col("id"), F.lit(partitions))).alias("partition"),
        F.col("id").alias("offset"), F.timestamp_seconds(F.col("id")).alias("timestamp"))


def drain(df, tmp, sink="parquet", **kw):
    q = start_query(df, sink, f"{tmp}/ck", "append", path=f"{tmp}/out", **kw)
    try:
        q.processAllAvailable()
        return [p for p in q.recentProgress if p["numInputRows"]]
    finally:
        q.stop()


def values(spark, tmp):
    return sorted(int(r[0]) for r in spark.read.parquet(f"{tmp}/out").select(F.col("value").cast("string")).collect())


def test_advance_shares_the_budget():
    assert tp.advance({}, {"0": 10, "1": 30}, None) == {"0": 10, "1": 30}
    assert tp.advance({}, {"0": 10, "1": 30}, 20) == {"0": 5, "1": 15}
    assert tp.advance({"0": 10}, {"0": 10, "1": 3000}, 20) == {"0": 10, "1": 20}
    assert tp.advance({"0": 4}, {"0": 5, "1": 1000}, 10) == {"0": 5, "1": 9}
    assert tp.advance({"0": 7}, {}, 10) == {}


def test_batches_are_bounded_and_a_restart_goes_on(spark, tmp):
    path = f"{tmp}/topic"
    tp.append_topic(records(spark, 0, 300), path)
    stream = lambda: tp.read_topic(spark, path, 100, f"{tmp}/position")
    first = drain(stream(), tmp)
    assert len(first) >= 3 and all(p["numInputRows"] <= 103 for p in first)
    assert values(spark, tmp) == list(range(300))
    tp.append_topic(records(spark, 300, 420), path)
    again = drain(stream(), tmp)      # a new query on the same checkpoint
    assert len(again) >= 2 and sum(p["numInputRows"] for p in again) == 120
    assert values(spark, tmp) == list(range(420))
    assert drain(stream(), tmp) == []


def test_a_noted_end_that_was_never_logged_loses_nothing(spark, tmp):
    """The driver dies between handing out an end and logging it."""
    path = f"{tmp}/topic"
    tp.append_topic(records(spark, 0, 200), path)
    tp.TopicReader({"path": path, "maxOffsetsPerTrigger": "50", "position": f"{tmp}/position"}).latestOffset()
    drain(tp.read_topic(spark, path, 50, f"{tmp}/position"), tmp)
    assert values(spark, tmp) == list(range(200))


def test_available_now_starting_offsets_and_order(spark, tmp):
    path = f"{tmp}/topic"
    tp.append_topic(records(spark, 0, 60), path)
    run_available_now(tp.read_topic(spark, path, starting_offsets={"0": 20, "1": 1000}), "parquet", f"{tmp}/ck", path=f"{tmp}/out")
    rows = {(r["partition"], r["offset"]) for r in spark.read.parquet(f"{tmp}/out").collect()}
    want = {(p, i) for i in range(60) for p in [0 if i % 2 == 0 else i % 3] if i >= {0: 20, 1: 1000}.get(p, 0)}
    assert rows == want
    with pytest.raises(ValueError, match="behind"):
        tp.append_topic(records(spark, 10, 20), path)
    assert len(tp.list_json(f"{path}/_manifest")) == 1


def test_a_hot_partition_is_read_by_several_tasks(spark, tmp):
    path = f"{tmp}/topic"
    for lo in range(0, 400, 100):
        tp.append_topic(records(spark, lo, lo + 100), path)
    r = tp.TopicReader({"path": path})
    parts = r.partitions({}, r.latestOffset())
    assert sum(p.partition == 0 for p in parts) >= 4
    assert sum(b.num_rows for p in parts for b in r.read(p)) == 400
    assert r.partitions({"0": 5}, {"0": 5}) == []


def test_committed_rows_and_a_refused_replay(spark, tmp):
    src, out = f"{tmp}/in", f"{tmp}/out"
    spark.range(50).write.parquet(src)
    fmt = cm.committed_sink(spark)
    stream = spark.readStream.schema("id long").parquet(src)
    run_available_now(stream, fmt, f"{tmp}/ck", path=out)
    assert sorted(r[0] for r in cm.read_committed(spark, out, "id long").collect()) == list(range(50))
    # Another checkpoint replays batch 0: refused, its files are gone.
    files = set(os.listdir(f"{out}/files"))
    run_available_now(stream, fmt, f"{tmp}/ck2", path=out)
    assert set(os.listdir(f"{out}/files")) == files and list(cm.commits(out)) == [0]
    assert cm.read_committed(spark, out, "id long").count() == 50
    assert cm.read_committed(spark, f"{tmp}/none", "id long").collect() == []


def test_a_killed_task_leaves_nothing_visible(spark, tmp):
    src, out, flag = f"{tmp}/in", f"{tmp}/out", f"{tmp}/died"
    spark.range(400).repartition(4).write.parquet(src)

    @F.udf(T.LongType())
    def once(i):
        if i == 250 and not os.path.exists(flag):
            open(flag, "w").close()
            raise RuntimeError("lost")
        return i

    stream = spark.readStream.schema("id long").parquet(src).select(once("id").alias("id"))
    fmt = cm.committed_sink(spark)
    with pytest.raises(Exception, match="lost"):
        run_available_now(stream, fmt, f"{tmp}/ck", path=out)
    assert cm.commits(out) == {} and cm.read_committed(spark, out, "id long").collect() == []
    run_available_now(stream, fmt, f"{tmp}/ck", path=out)
    assert sorted(r[0] for r in cm.read_committed(spark, out, "id long").collect()) == list(range(400))
    named = {f["file"] for b in cm.commits(out).values() for f in b}
    assert named <= set(os.listdir(f"{out}/files"))
