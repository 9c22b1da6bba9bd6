"""The ALS solver against plain normal equations, in layouts of several kinds."""

import os
import random

import numpy as np
import pytest
from pyarrow import fs as pafs
from pyspark import StorageLevel
from pyspark.sql import functions as F

from livetable.operators import als
from livetable.operators import recommend as rec
from livetable.plans import queries as q

SCHEMA = "student_id int, question_id int, rating float"


def _ratings(n=600, users=37, items=23, seed=5):
    rng = random.Random(seed)
    rows = [(rng.randrange(users) * 3 - 20, rng.randrange(items) * 2 + 1, float(rng.randint(1, 3))) for _ in range(n)]
    return rows + rows[:40]     # repeated answers are ratings of their own


def _half(rows, source, reg):
    """own id -> factors, by the normal equations; rows: (own, other, rating)."""
    out = {}
    for own in {r[0] for r in rows}:
        m = np.array([source[o] for x, o, _ in rows if x == own], dtype=np.float64)
        r = np.array([v for x, _, v in rows if x == own])
        out[own] = np.linalg.solve(m.T @ m + reg * len(r) * np.eye(m.shape[1]), m.T @ r)
    return out


def _expected(rows, rank, iterations, reg, seed):
    ids = np.array(sorted({r[0] for r in rows}), dtype=np.int32)
    users = dict(zip(ids.tolist(), als._first(ids, rank, seed)))
    for _ in range(iterations):
        items = _half([(o, s, r) for s, o, r in rows], users, reg)
        users = _half(rows, items, reg)
    return users, items


def _factors(df):
    return {r["id"]: np.array(r["features"]) for r in df.collect()}


def _same(got, want):
    assert set(got) == set(want)
    assert all(np.allclose(got[i], want[i], atol=2e-4) for i in want)


@pytest.mark.parametrize("parts, chunk", [(1, 1 << 18), (3, 7), (5, 30)])
def test_factors_are_those_of_the_normal_equations(spark, monkeypatch, parts, chunk):
    """Whatever the parts and chunks (ids have more ratings than a chunk of 7)."""
    monkeypatch.setattr(als, "CHUNK", chunk)
    rows = _ratings()
    users, items = als.fit(spark.createDataFrame(rows, SCHEMA).repartition(4), "student_id", "question_id", "rating",
                           parts, rank=4, max_iter=3, reg_param=0.09, seed=11)
    want = _expected(rows, 4, 3, 0.09, 11)
    _same(_factors(users), want[0])
    _same(_factors(items), want[1])


def _chunks(own, place, rating, size):
    out, row = [], 0
    for lo in range(0, len(own), size):
        o = own[lo:lo + size]
        before, after = int(lo > 0 and own[lo - 1] == o[0]), int(lo + size < len(own) and own[lo + size] == o[-1])
        row -= before
        out.append(als._place(o, place[lo:lo + size], rating[lo:lo + size], row, before, after))
        row += len(np.unique(o))
    return out


@pytest.mark.parametrize("size, solved, single", [(1 << 18, 4096, 512), (500, 3, 100), (100, 1, 16), (1, 4096, 512)])
def test_a_hot_id_is_summed_over_chunks(monkeypatch, size, solved, single):
    monkeypatch.setattr(als, "SOLVED", solved)
    monkeypatch.setattr(als, "SINGLE", single)
    rng = np.random.default_rng(1)
    own = np.sort(np.concatenate([np.full(700, 3), np.full(400, 99), rng.integers(0, 100, 300)])).astype(np.int32)
    place, rating = rng.integers(0, 50, len(own)).astype(np.uint32), rng.integers(1, 4, len(own)).astype(np.float32)
    source = rng.normal(size=(50, 3)).astype(np.float32)
    pieces = [source[:20], source[20:21], source[21:]]
    got = als._solve_part(iter(_chunks(own, place, rating, size)), len(np.unique(own)), pieces, 3, 0.1)
    want = _half(list(zip(own.tolist(), place.tolist(), rating.tolist())), source, 0.1)
    assert np.allclose(got, [want[i] for i in sorted(want)], atol=1e-4)


def test_the_model_does_not_depend_on_the_blocks(spark):
    """Nor is a block ever held whole; blocks of Spark's own solver gave other starting factors."""
    rows = spark.createDataFrame(_ratings(), "student_id long, question_id long, rating float")
    one, many = (rec.train(rows, rank=3, max_iter=4, num_blocks=n) for n in (1, 7))
    for a, b in ((one.userFactors, many.userFactors), (one.itemFactors, many.itemFactors)):
        _same(_factors(a), _factors(b))
    for ratings in (0, 400, 10 ** 6, 28_800_000, 172_800_000, 10 ** 10):
        n = rec.part_count(ratings, 12)
        assert n >= rec.block_count(ratings, 12) and ratings <= n * rec.SORTED_RATINGS


def test_the_fit_is_as_good_as_that_of_spark(spark):
    rows = spark.createDataFrame(_ratings(4000, 150, 90), SCHEMA).persist()
    own = rec.train(rows, rank=5, max_iter=10)
    theirs = rec.make_als(rank=5, max_iter=10).fit(rows)
    assert own.userFactors.schema.simpleString() == theirs.userFactors.schema.simpleString()
    settings = [{p.name: v for p, v in m.extractParamMap().items()} for m in (own, theirs)]
    assert settings[0] == settings[1]
    a, b = (rec.evaluate(rec.predict(m, rows)) for m in (own, theirs))
    assert abs(a - b) < 0.05 * b


def test_files_of_storage_that_cannot_be_mapped_are_copied(monkeypatch, tmp):
    want = np.arange(7, dtype=np.float32)
    want.tofile(f"{tmp}/a")
    assert np.array_equal(als._map(f"{tmp}/a", np.float32, 7), want)
    monkeypatch.setattr(als, "open_fs", lambda path: (pafs.SubTreeFileSystem("/", pafs.LocalFileSystem()), path.lstrip("/")))
    assert np.array_equal(als._map(f"{tmp}/a", np.float32, 7), want)


def test_working_files_go_and_factors_stay(spark, monkeypatch, tmp):
    monkeypatch.setattr(als, "shared_dir", lambda spark, *names, unique: os.path.join(tmp, *names))
    model = rec.train(spark.createDataFrame(_ratings(), SCHEMA), rank=2, max_iter=2)
    assert os.listdir(os.path.join(tmp, "als")) == ["factors"]
    assert model.userFactors.count() == len({r[0] for r in _ratings()})


def test_no_ratings_and_ratings_without_a_number_are_errors(spark):
    with pytest.raises(Exception, match="No ratings"):
        rec.train(spark.createDataFrame([], SCHEMA))
    for bad in (None, float("nan")):
        with pytest.raises(Exception, match="rating is null or not a number"):
            rec.train(spark.createDataFrame([(1, 2, 1.0), (1, 3, bad)], SCHEMA), num_blocks=1)


def test_training_uses_all_cores():
    """It ran in the two tasks of two blocks, whatever the cluster."""
    for ratings in (2_000_000, 28_800_000, 172_800_000):
        assert rec.part_count(ratings, 12) % 12 == 0
    assert rec.part_count(400, 12) == 2 and rec.part_count(400, 1) == 1


def test_rows_kept_for_training_are_kept_on_disk(spark, monkeypatch):
    answers = spark.createDataFrame([(f"s_{s}", f"q_{p}", p % 11, f"1998-01-0{1 + s // 10} 12:00:00") for s in range(1, 31) for p in range(1, 13)],
                                    "student_id string, question_id string, score int, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    monkeypatch.setattr(q.st, "answers", lambda *_: answers)
    kept, persist = [], type(answers).persist
    monkeypatch.setattr(type(answers), "persist", lambda self, *level: (kept.extend(level or ["default"]), persist(self, *level))[1])
    assert q.q_als_recommend_all(spark, "unused").count() == 30
    assert kept == [StorageLevel.DISK_ONLY] * 2
