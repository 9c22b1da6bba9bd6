"""FM-index and decontamination against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from livetable.llm import decontaminate as d
from livetable.llm.fm_index import FMIndex, suffix_order
from livetable.llm.queries import QUERIES

from conftest import ALNUM, SF001, lower, rows_of, sha


def brute(docs, items, window=10):
    phrases = {}
    for iid, text in items:
        w = ALNUM.findall(lower(text))
        for k in range(max(len(w) - window + 1, 1 if w else 0)):
            phrases.setdefault(tuple(w[k:k + window]), set()).add(iid)
    out = []
    for i, text in docs:
        w, found = ALNUM.findall(lower(text)), set()
        hit = [False] * len(w)
        for n in {len(p) for p in phrases}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in phrases:
                    found |= phrases[tuple(w[k:k + n])]
                    hit[k:k + n] = [True] * n
        ids = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), sum(hit), len(ids), sha(",".join(ids)), any(hit)))
    return sorted(out, key=str)


def digest(found):
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return rows_of(found.select("doc_id", "n_words", hit.alias("hit"), F.size("items").cast("long").alias("n"),
                                F.sha2(F.concat_ws(",", "items"), 256).alias("h"), (hit > 0).alias("c")), "doc_id", "n_words", "hit", "n", "h", "c")


def test_suffix_order_and_index():
    rng = np.random.default_rng(1)
    for _ in range(60):
        text = np.concatenate([[0], rng.integers(0, 4, rng.integers(1, 80)), [0]])
        sa = suffix_order(text)
        zeros = {int(p): k for k, p in enumerate(np.flatnonzero(text == 0))}
        key = lambda p: [(0, zeros[q]) if q in zeros else (1, int(text[q])) for q in range(p, len(text))]
        assert sa.tolist() == sorted(range(len(text)), key=key)
        index = FMIndex(text, 5)
        for n in (1, 2, 3, 5):
            pattern = rng.integers(1, 4, n)
            table = np.zeros((1, 6), np.int64)
            table[0, 6 - n:] = pattern
            lo, hi = index.search(table, np.array([n]))
            want = [p for p in range(len(text) - n + 1) if (text[p:p + n] == pattern).all()]
            assert sorted(index.locate(np.arange(int(lo[0]), max(int(hi[0]), int(lo[0])))).tolist()) == want


@pytest.mark.parametrize("block_bytes", [d.BLOCK_BYTES, 300])
def test_against_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(d, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(d, "SHARD_BYTES", 700)
    rng = random.Random(6)
    words = ["a", "B", "é", "c1", "dd"]
    items = [(k, " ".join(rng.choice(words) for _ in range(n))) for k, n in enumerate([0, 1, 3, 9, 10, 11, 25, 30, 30])]
    items += [(3, items[3][1]), (20, None), (21, " . "), (None, " ".join(["c1"] * 12)), (22, items[6][1])]
    docs = []
    for i in range(70):
        w = [rng.choice([*words, "zz", "q-q", "--"]) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            w[rng.randint(0, len(w)):0] = ["zz", rng.choice(items)[1] or "", "--"]
        docs.append((i, "  ".join(w)))
    docs += [(100, None), (101, ""), (102, " - "), (None, items[6][1]), (103, items[6][1] + " x " + items[7][1]), (103, "zz"),
             (104, "a B dd " * 4000), (105, "c1 " * 40)]
    items = [x for x in items if x[0] != 1]     # a one-word item hits nearly everything
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as spans", "2 as items")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert digest(d.contamination(df, bench)) == brute(docs, items)


def test_query_on_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    got = rows_of(QUERIES["op5_benchmark_decontamination"](spark, SF001), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == brute(docs, items) and any(r[5] for r in got)


def test_cleaned_text_and_empty_tables(spark):
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "Say: One, two THREE! four"), (2, "one two  four"), (3, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["cleaned"] for r in d.contamination(docs, bench, clean=True).collect()}
    assert got == {1: "Say: ! four", 2: "one two  four", 3: None}
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(r["spans"] == [] for r in d.contamination(docs, none).collect())
    assert d.contamination(docs.limit(0), bench).collect() == []


def test_blocks_are_bounded_for_a_hot_text(spark, monkeypatch):
    """A text that most items share, repeated items, and items without words."""
    monkeypatch.setattr(d, "BLOCK_BYTES", 600)
    seen, compiled = [], d.phrases

    def phrases(texts, ids, window):
        seen.append(sum(len((t or "").encode()) + len(i or "") for t, i in zip(texts, ids)))
        return compiled(texts, ids, window)

    monkeypatch.setattr(d, "phrases", phrases)
    hot = "one two three four five six seven eight nine ten eleven"
    items = [(f"hot-{k}", hot) for k in range(25)] * 2 + [("n" * 50 + str(k), None) for k in range(30)] + [("blank" * 20, " .")] * 9
    items += [("rare", "alpha beta gamma"), (None, "delta epsilon"), ("é", "zeta é")]
    docs = [(1, f"x {hot} y"), (2, "alpha beta gamma delta epsilon"), (3, "ten nine eight"), (4, "the zeta é"), (5, None)]
    found = d.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string"))
    assert digest(found) == brute(docs, items)
    assert len(seen) > 3 and max(seen) <= d.BLOCK_BYTES
