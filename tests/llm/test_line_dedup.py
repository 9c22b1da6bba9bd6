"""Repeated lines against brute force, in one batch and in many."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from livetable.llm import line_dedup as d
from livetable.llm.queries import QUERIES

from conftest import SF001, rows_of, sha

WHITE = b" \t\n\x0b\x0c\r"


def key(line):
    k = line.encode().strip(WHITE)
    return bytes(c + 32 if 65 <= c <= 90 else c for c in k).decode()


def brute(rows, threshold=10, min_chars=1):
    split = [(t or "").split("\n") for _, t in rows]
    found = Counter()
    for lines in split:
        found.update({k for k in map(key, lines) if len(k) >= min_chars})
    out = []
    for (i, _), lines in zip(rows, split):
        kept = [x for x in lines if found[key(x)] < threshold]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return sorted(out, key=str)


def digest(df):
    out = df.select("doc_id", "n_lines", F.size("dropped").cast("long").alias("n_dropped"), F.sha2("kept", 256).alias("sha"))
    return rows_of(out, "doc_id", "n_lines", "n_dropped", "sha")


def odd_rows():
    rng = random.Random(11)
    common = ["Read more", "ÉTÉ à Paris", "\x0b©  all Rights", "a", "…", "x" * 5000]
    rows = []
    for i in range(160):
        lines = [rng.choice(common) if rng.random() < 0.4 else f"line {rng.randint(0, 90)}" for _ in range(rng.randint(0, 9))]
        lines = [rng.choice(["", " ", "\t", "\r"]) + (x.upper() if rng.random() < 0.3 and x.isascii() else x) + rng.choice(["", "\x0c ", "\r"]) for x in lines]
        rows.append((i, "\n".join(lines)))
    rows += [(None, "read MORE\nown"), (None, "read MORE\nown"), (None, None), (500, None), (501, ""), (502, "\n\n"), (503, "\n".join(["a"] * 3000)),
             (3, rows[3][1]), (3, rows[3][1]), (504, " a\na "), (505, "Été à Paris\nété À Paris"), (506, "long " * 40_000 + "\na")]
    return rows


@pytest.mark.parametrize("batches,fan,threshold,min_chars", [(1, 4, 10, 1), (7, 2, 10, 1), (9, 3, 3, 4), (3, 4, 1, 1)])
def test_against_brute_force(spark, batches, fan, threshold, min_chars):
    rows = odd_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as h", "2 as n", "3 as a", "4 as dropped", "'x' as key")
    parts = [df.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)) == k) for k in range(batches)]
    assert digest(d.drop_repeated_lines(df, parts, threshold, min_chars, fan)) == brute(rows, threshold, min_chars)


def test_runs_are_levelled_and_decided_keys_are_not_added_again(spark):
    runs = d.LineRuns(spark, threshold=3, fan=2)
    batch = spark.createDataFrame([(k, "same\nonly " + str(k)) for k in range(4)], "doc_id long, text string")
    sizes = []
    for _ in range(4):
        runs.add(batch)
        sizes.append([len(x) for x in runs.levels])
    assert sizes == [[1], [0, 1], [1, 1], [0, 0, 1]]
    # "same" is decided after the first batch; the others reach 3 in the third, but are decided by the compactions.
    assert {r["n"] for r in runs._all().collect()} == {4}
    assert runs.decided().count() == 5
    runs.close()
    assert runs._all() is None


def test_merge_anti_join_reads_runs_without_shuffle(spark):
    runs = d.LineRuns(spark, threshold=2, fan=2)
    batch = spark.createDataFrame([(k, "same") for k in range(4)], "doc_id long, text string")
    runs.add(batch)
    joined = d.line_counts(batch).join(runs._all("decided").select("h", "g").hint("merge"), ["h", "g"], "left_anti")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    runs.close()
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 1


def test_query_on_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(QUERIES["op11_line_dedup"](spark, SF001), "doc_id", "n_lines", "n_dropped", "kept_sha256") == brute(rows)


def test_empty_table_and_file_batches(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert d.drop_repeated_lines(empty).collect() == []
    spark.range(100).repartition(5).write.parquet(str(tmp_path / "t"))
    parts = d.file_batches(spark.read.parquet(str(tmp_path / "t")), 3)
    assert len(parts) == 3 and sorted(r[0] for p in parts for r in p.collect()) == list(range(100))
