"""Ranked search against brute force, whatever the tiles and blocks."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from livetable.llm import lexical_rank as x
from livetable.llm.queries import QUERIES

from conftest import ALNUM, SF001, lower, rows_of


def brute(docs, items, k=50):
    tf = [Counter(ALNUM.findall(lower(t))) for _, t in docs]
    n_docs, n_terms = sum(bool(c) for c in tf), sum(sum(c.values()) for c in tf)
    df = Counter(t for c in tf for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(ALNUM.findall(lower(t)))
    out = []
    for i, terms in asked.items():
        scores = []
        for (d, _), c in zip(docs, tf):
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // max(n_terms, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                    for t in terms if c[t])
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(i, r, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [{}, {"TILE_DOCS": 7, "BLOCK_ITEMS": 2, "BLOCK_TERMS": 3, "PAIRS": 30}, {"EXACT": 1}])
def test_against_brute_force(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(x, name, value)
    rng = random.Random(12)
    word = lambda: rng.choice(["alpha", "Beta", "ÉTÉ", "été", "x1", "of", "the", "zq%d" % rng.randint(0, 40)])
    docs = [(i, " ".join(word() + rng.choice(["", ",", "\n", "--"]) for _ in range(rng.randint(0, 30)))) for i in range(150)]
    docs += [(None, docs[3][1]), (None, docs[3][1]), (7, docs[7][1]), (200, None), (201, ""), (202, "- .. \n"),
             (203, "alpha " * 30_000), (204, "w" * 100_000 + " beta")]
    docs += [(300 + i, "same words of the Beta") for i in range(90)]
    items = [(i, " ".join(word() for _ in range(rng.randint(0, 20)))) for i in range(9)]
    items += [(None, "the beta"), (3, "beta x1"), (50, None), (51, ""), (52, "nowhere found"), (53, "words of Beta the same the")]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as n", "2 as score", "3 as item_id")
    q = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as doc_id", "2 as rank")
    assert rows_of(x.rank(d, q, k=50), "item_id", "rank", "doc_id", "score") == brute(docs, items)
    assert rows_of(x.rank(d, q, k=3), "item_id", "rank", "doc_id", "score") == brute(docs, items, 3)


def test_products_stay_exact_beyond_what_one_float_sum_holds():
    """The same large weights summed over many slices equal integer arithmetic."""
    rng = np.random.default_rng(1)
    weight = rng.integers(1 << 20, 1 << 21, 1000)
    impact = rng.integers(1 << 30, 1 << 31, 1000)
    block = (0, 1, np.arange(1000), np.zeros(1000, np.int64), np.arange(1000))
    got = x._scores(block, weight, np.zeros(1000, np.int32), np.arange(1000, dtype=np.int32), impact, 1)
    assert int(got[0, 0]) == sum(int(a) * int(b) for a, b in zip(weight, impact)) > x.EXACT


def test_length_factor_does_not_overflow():
    n, n_docs, n_terms = np.array([10**12]), 10**9, 10**13
    m = 50 + (50 * 10**12 * n_docs) // n_terms
    assert x.impacts(np.array([3]), n, n_docs, n_terms).tolist() == [3 * 10**9 // (3000 + 20 * m)]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "b")], "item_id long, text string")
    assert x.rank(docs.limit(0), items).collect() == []
    assert x.rank(docs, items.limit(0)).collect() == []
    assert [tuple(r) for r in x.rank(docs, items).collect()] == brute([(1, "a b")], [(1, "b")])


def test_query_on_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").select("item_id", "text").collect()]
    assert rows_of(QUERIES["op12_lexical_rank"](spark, SF001), "item_id", "rank", "doc_id", "score") == brute(docs, items)
