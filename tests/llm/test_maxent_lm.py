"""Language model: base score against brute force, a proper distribution, and gain on
held-out texts."""

import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from livetable.llm import maxent_lm as m
from livetable.llm.queries import QUERIES

from conftest import SF0001, SF001, SPACED, lower


def base(rows, held):
    count = Counter()
    split = [[*SPACED.findall(lower(t)), None] for _, t in rows]
    for (i, _), w in zip(rows, split):
        if not held(i):
            count.update(w)
    n, v = sum(count.values()), len(count)
    return [(i, held(i), len(w), sum(count[x] > 0 for x in w), n, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w))
            for (i, _), w in zip(rows, split)]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def compare(got, want):
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got), key=str)
    want = sorted(want, key=str)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) <= 1e-9 * max(1, abs(b[5])), (a, b)


def test_base_on_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()]
    compare(QUERIES["op10_maxent_lm"](spark, SF0001).collect(), base(rows, held))


def test_odd_rows(spark):
    rows = [(1, "A b a"), (2, None), (3, ""), (None, "a new"), (4, "é \x00 w" + "x" * 90_000), (4, "b b"), (4, "b b"), (9, "unseen words")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as shard", "'q' as kind")
    got = m.score(df, F.crc32(F.col("doc_id").cast("string")) % 7 == 2).collect()
    compare(got, base(rows, held))
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    assert m.score(df.limit(0), F.lit(False)).collect() == []


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    r = m.score(df, F.lit(True)).first()
    assert r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == 0.0 and math.isfinite(r["score"])


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(3)
    for sizes in (m.sizes_for(10), m.sizes_for(40 << 20)):
        weights = tuple(rng.normal(size=(n, sizes.width)).astype(np.float32) for n in (sizes.class_rows, sizes.slot_rows))
        hist = np.repeat(rng.integers(0, 2**63, (m.FEATURES, 1), dtype=np.uint64), sizes.slots, axis=1)
        p = np.exp(m.log_probability(weights, np.arange(sizes.slots), hist, sizes))
        assert abs(p.sum() - 1) < 1e-4


def test_segment_sums():
    rng = np.random.default_rng(5)
    for lengths in ([1], [7], [1, 1, 1], [3, 1, 900, 2, 1], rng.integers(1, 40, 300).tolist()):
        cut = np.cumsum([0, *lengths[:-1]])
        x = rng.normal(size=(sum(lengths), 4))
        assert np.allclose(m.segment_sums(x.copy(), cut), np.add.reduceat(x, cut, axis=0))


def test_model_grows_with_the_vocabulary():
    sizes = [m.sizes_for(v) for v in (0, 2**20, 2**22, 2**25, 2**28, 2**31, 2**45)]
    weights = [4 * s.width * (s.class_rows + s.slot_rows) for s in sizes]
    assert weights[0] == weights[1] and all(a < b for a, b in zip(weights[1:], weights[2:]))
    assert weights[-1] <= m.MOST_BYTES * 1.05
    assert all(s.heads + s.tails + 1 == s.slots for s in sizes)


def score_in_files(spark, tmp_path, files, train_bytes):
    path = f"{tmp_path}/{files}_{train_bytes}"
    spark.read.parquet(f"{SF001}/documents.parquet").repartition(files, F.xxhash64("doc_id", F.lit(files))).write.parquet(path)
    got = m.score(spark.read.parquet(path), F.crc32(F.col("doc_id").cast("string")) % 7 == 2, train_bytes=train_bytes)
    return {r["doc_id"]: (r["held_out"], r["n_tokens"], r["base_score"], r["score"]) for r in got.collect()}


def test_files_change_nothing(spark, tmp_path):
    """One, 6 and 40 files, and one or several training shards a round."""
    gain = {}
    for train_bytes in (m.TRAIN_BYTES, 1 << 20):
        one, *others = (score_in_files(spark, tmp_path, files, train_bytes) for files in (1, 6, 40))
        for other in others:
            assert max(abs(a[3] - other[i][3]) / -a[3] for i, a in one.items()) < 1e-6
        kept = [x for x in one.values() if x[0]]
        gain[train_bytes] = sum(x[3] - x[2] for x in kept) / sum(x[1] for x in kept)
    print(gain)
    assert min(gain.values()) > 0.05


def test_history_stays_inside_documents():
    keys = np.arange(10, 17).astype(np.uint64)
    h = m.history(keys, np.array([0, 3, 3, 7]))
    alone = np.concatenate([m.history(keys[:3], np.array([0, 3])), m.history(keys[3:], np.array([0, 4]))], axis=1)
    assert (h == alone).all()


def test_model_beats_base_on_held_out_texts(spark):
    got = QUERIES["op10_maxent_lm"](spark, SF001).filter("held_out").agg(
        F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.sum("n_tokens").alias("n")).first()
    assert got["s"] / got["n"] > got["b"] / got["n"] + 0.05


def test_word_three_back_is_seen():
    a, b = (m.history(np.array([first, 20, 21, 22], np.uint64), np.array([0, 4])) for first in (10, 11))
    differs = (a[:, 3] != b[:, 3])
    assert differs.sum() == 1 and len(a) == m.FEATURES == 4
    assert len({tuple(m.rows_of(h, None, m.sizes_for(0))[:, 3]) for h in (a, b)}) == 2


def test_counts_of_keys():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 500):
        word = np.unique(np.r_[rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2), np.arange(min(n, 40), dtype=np.uint64)])
        if n == 500:
            word = np.append(word, np.uint64(2**64 - 1))
        count = rng.integers(1, 99, len(word))
        known = dict(zip(word.tolist(), count.tolist()))
        keys = np.r_[word, rng.integers(0, 2**63, 300).astype(np.uint64), np.array([0, 2**64 - 1, 41], np.uint64)]
        assert m.counts_of(keys, word, count).tolist() == [known.get(k, 0) for k in keys.tolist()]
