"""Exact top-k by pruning, range counts, late rows kept, state as a table."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from livetable.functions.text import split_words
from livetable.operators import products as pr
from livetable.operators.aggregate import count_by
from livetable.operators.integrity import missing_ids, missing_ids_by_range
from livetable.sources.files import read_lines
from livetable.streaming import late
from livetable.streaming.sinks import run_available_now
from livetable.streaming.state import counts_in_state, read_state, state_operators


def vectors(rng, n, norms):
    v = rng.normal(size=(n, 6))
    return (v / np.linalg.norm(v, axis=1, keepdims=True) * norms[:, None]).astype(np.float32)


@pytest.mark.parametrize("group_bytes,block", [(32 << 20, 16), (4_000, 8), (64, 256)])
def test_top_products_equal_brute_force(spark, monkeypatch, group_bytes, block):
    monkeypatch.setattr(pr, "GROUP_BYTES", group_bytes)
    monkeypatch.setattr(pr, "BLOCK", block)
    rng = np.random.default_rng(5)
    items = vectors(rng, 300 if group_bytes > 64 else 12, np.exp(rng.normal(0, 1.2, 300 if group_bytes > 64 else 12)))
    items[7] = items[3]                                 # a tie
    users = vectors(rng, 90, np.exp(rng.normal(0, 1, 90)))
    users[0] = 0
    as_rows = lambda m: [(i, [float(x) for x in v]) for i, v in enumerate(m)]
    u = spark.createDataFrame([*as_rows(users), (500, None)], "id long, features array<float>")
    v = spark.createDataFrame([*as_rows(items), (600, None)], "id long, features array<float>")
    got = {r["id"]: r for r in pr.top_products(u, v, 10).collect()}
    assert set(got) == set(range(90))
    score = users.astype(np.float64) @ items.astype(np.float64).T
    for i, r in got.items():
        order = np.lexsort((np.arange(len(items)), -np.round(score[i], 12)))[:10]
        assert [x["id"] for x in r["best"]] == order.tolist(), i
        assert np.allclose([x["score"] for x in r["best"]], score[i][order])
    if group_bytes == 32 << 20:
        assert sum(r["scored"] for r in got.values()) < 0.7 * 90 * 300      # pruned


def test_top_products_of_few_items_and_none(spark):
    u = spark.createDataFrame([(1, [1.0, 0.0])], "id long, features array<float>")
    v = spark.createDataFrame([(4, [2.0, 0.0]), (5, [3.0, 1.0])], "id long, features array<float>")
    assert [(x["id"], x["score"]) for x in pr.top_products(u, v, 10).first()["best"]] == [(5, 3.0), (4, 2.0)]
    assert pr.top_products(u, v.limit(0), 10).first()["best"] == []
    assert pr.top_products(u.limit(0), v, 10).collect() == []


@pytest.mark.parametrize("lo,hi", [(1, 100_000), (0, 32_767), (-40_000, 70_000), (5, 5), (10, 32_778)])
def test_missing_ids_by_range(spark, lo, hi):
    rng = random.Random(hi)
    gone = {rng.randint(lo, hi) for _ in range(20)} | ({hi} if hi > 40_000 else set()) | set(range(lo + 33_000, min(lo + 99_000, hi)))
    ids = [i for i in range(lo, hi + 1) if i not in gone]
    df = spark.createDataFrame([(i,) for i in [*ids, *ids[:50], None, lo - 3, hi + 9]], "id long").repartition(4)
    got = sorted(r[0] for r in missing_ids_by_range(spark, df, "id", lo, hi).collect())
    assert got == sorted(x for x in gone if lo <= x <= hi)
    assert got == sorted(r[0] for r in missing_ids(spark, df, "id", lo, hi).collect())


def test_full_ranges_shuffle_bitmaps_only(spark):
    df = spark.range(1, 200_000)
    out = missing_ids_by_range(spark, df, "id", 1, 199_999)
    assert out.collect() == []
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_construct_agg" in plan and "hashpartitioning(id" not in plan


def rows_at(spark, *rows):
    return spark.createDataFrame(rows, "t string, k string").selectExpr("cast(t as timestamp_ntz) t", "k")


def test_late_rows_are_kept_and_a_replay_changes_nothing(spark, tmp):
    step = late.count_windows(f"{tmp}/w", "t", "k", "1 minute", "2 minutes")
    batches = [rows_at(spark, ("2024-01-01 10:00:10", "a"), ("2024-01-01 10:00:50", "a"), (None, "n")),
               rows_at(spark, ("2024-01-01 10:05:00", "b"), ("2024-01-01 10:00:20", "a")),     # closes up to 10:03
               rows_at(spark, ("2024-01-01 10:02:59", "a"), ("2024-01-01 10:03:00", "c")),     # the first is late
               rows_at(spark),
               rows_at(spark, ("2024-01-01 11:00:00", "d"))]

    def tables():
        final = sorted((r["window_start"].strftime("%H:%M"), r["k"], r["count"]) for r in late.final_windows(spark, f"{tmp}/w", "k", "1 minute").collect())
        still = sorted((r["window_start"].strftime("%H:%M"), r["k"], r["count"]) for r in late.open_windows(spark, f"{tmp}/w", "k", "1 minute").collect())
        return final, still, sorted((str(r["t"]), r["k"], r["batch_id"]) for r in late.late_rows(spark, f"{tmp}/w").collect())

    for n, b in enumerate(batches):
        step(b, n)
        if n in (1, 2):
            step(b, n)      # the same batch again
    want = ([("10:00", "a", 3), ("10:03", "c", 1), ("10:05", "b", 1)], [("11:00", "d", 1)],
            [("2024-01-01 10:02:59", "a", 2), ("None", "n", 0)])
    assert tables() == want
    step(batches[4], 4)
    assert tables() == want


def test_state_equals_the_count_before_and_after_a_restart(spark, tmp):
    src, ck = os.path.join(tmp, "in"), os.path.join(tmp, "ck")
    os.makedirs(src)

    def run(name, text):
        with open(os.path.join(src, name), "w") as f:
            f.write(text)
        run_available_now(count_by(split_words(read_lines(spark, src, stream=True)), "word"), "noop", ck, "update")
        return {r["word"]: r["count"] for r in counts_in_state(spark, ck, "word").collect()}

    assert run("1", "b a b\n") == {"a": 1, "b": 2}
    assert run("2", "c a\n") == {"a": 2, "b": 2, "c": 1}
    assert {r["word"]: r["count"] for r in counts_in_state(spark, ck, "word", batch_id=0).collect()} == {"a": 1, "b": 2}
    assert read_state(spark, ck).select(F.count_distinct("partition_id")).first()[0] >= 1
    assert state_operators(spark, ck).select("operatorName").first()[0] == "stateStoreSave"


def test_utc_micros_of_times_that_a_zone_does_not_have(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from livetable.functions.timefns import utc_micros
    times = [dt.datetime(2024, 3, 31, 2, 30, 1, 123456), dt.datetime(2024, 10, 27, 2, 30), dt.datetime(1969, 12, 31, 23, 59, 59, 999999),
             dt.datetime(1800, 1, 1, 0, 0, 0, 1), dt.datetime(9999, 12, 31, 23, 59, 59, 999999), None]
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    want = [None if t is None else (t - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1) for t in times]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Europe/Berlin", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert [r.n for r in df.select(utc_micros(F.col("ts")).alias("n")).collect()] == want, zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
