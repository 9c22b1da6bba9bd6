"""Repeated passages against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from livetable.llm import phrase_dedup as p
from livetable.llm.queries import QUERIES

from conftest import SF001, SPACED, rows_of, sha


def brute(rows, window=13):
    split = [SPACED.findall((t or "").encode()) for _, t in rows]
    low = {}
    for (i, _), w in zip(rows, split):
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[k:k + window])
                low[key] = min(low.get(key, i), i)
    out = []
    for (i, _), w in zip(rows, split):
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and low[tuple(w[k:k + window])] < i:
                gone[k:k + window] = [True] * window
        out.append((i, len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g))))
    return sorted(out, key=str)


def digest(df):
    n = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return rows_of(df.select("doc_id", "n_words", n.alias("n_removed"), F.sha2("kept", 256).alias("h")), "doc_id", "n_words", "n_removed", "h")


@pytest.mark.parametrize("phrases", [p.PHRASES, 7])
def test_against_brute_force(spark, monkeypatch, phrases):
    monkeypatch.setattr(p, "SHARD_BYTES", 20_000)
    monkeypatch.setattr(p, "PHRASES", phrases)
    rng = random.Random(8)
    passages = [[rng.choice("abcdefgh") * rng.randint(1, 12) for _ in range(rng.randint(13, 60))] for _ in range(5)]
    rows = []
    for i in rng.sample(range(1000), 70):
        text = " ".join(rng.choice(["x", "é", "qq\n", "w\t\t"]) + str(rng.randint(0, 99)) for _ in range(rng.randint(0, 40)))
        for _ in range(rng.randint(0, 3)):
            w = rng.choice(passages)
            a = rng.randrange(len(w))
            text += " " + " ".join(w[a:a + rng.randint(5, 50)]) + f" {i}"
        rows.append((i, text))
    rows += [(None, rows[3][1]), (None, None), (rows[7][0], rows[7][1]), (rows[4][0], rows[9][1]), (2000, None), (2001, ""),
             (2002, "a " * 3000), (2003, "a " * 40), (2004, "long" * 30_000 + " " + rows[11][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as shard", "2 as cell")
    assert digest(p.repeated_phrases(df, joined=True)) == brute(rows)


def test_query_on_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(QUERIES["op8_substring_dedup"](spark, SF001), "doc_id", "n_words", "n_removed", "kept_sha256") == brute(rows)


def test_cleaned_text_carries_columns(spark):
    passage = " ".join(f"p{k}" for k in range(20))
    rows = [(1, f"one  {passage}\ntwo", "en"), (2, f"a\tb {passage}  c\n d", "de"), (3, None, None), (4, "x  y", "fr")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: (r["cleaned"], r["lang"]) for r in p.repeated_phrases(df, cleaned=True, carry=("lang",)).collect()}
    assert got == {1: (rows[0][1], "en"), 2: ("a\tb c\n d", "de"), 3: (None, None), 4: ("x  y", "fr")}
    assert p.repeated_phrases(df.limit(0)).collect() == []
