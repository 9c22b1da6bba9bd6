"""Collocations against brute force; the summaries' guarantee by itself."""

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from livetable.llm import collocations as c
from livetable.llm.queries import QUERIES

from conftest import SF001, lower, rows_of

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def brute(rows, sizes=(2, 3), min_count=10, cover=50, top=2000):
    f, total = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(rb"[.,;:!?\x0a-\x0d]", lower(text)):
            w = re.findall(rb"[^\x20\x09]+", piece)
            total[lang] += len(w)
            f.setdefault(lang, Counter()).update(tuple(w[i:i + n]) for n in range(1, sizes[1] + 1) for i in range(len(w) - n + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) >= sizes[0] and a >= min_count}
        longer = {}
        for p, a in found.items():
            for n in range(sizes[0], len(p)):
                for i in range(len(p) - n + 1):
                    longer[p[i:i + n]] = max(longer.get(p[i:i + n], 0), a)
        kept = []
        for p, a in found.items():
            if 100 * longer.get(p, -1) >= cover * a:
                continue
            score, _, l, r = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, b" ".join(p), l, r))
        out += [(lang, k, p.decode(), -a, l, r, total[lang], -s) for k, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out, key=str)


def odd_rows():
    rng = random.Random(13)
    vocabulary = ["new", "York", "city", "été", "of", "the", "hot", "dog"] + [f"w{k}" for k in range(25)]
    rows = []
    for k in range(260):
        words = []
        for _ in range(rng.randint(0, 40)):
            words.append(rng.choice(["New York city", "hot dog", "the of", *vocabulary]))
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", "! "]) for w in words)
        rows.append((rng.choice(["en", "en", "fr", None, "und"]), text))
    return rows + [("de", None), ("de", ""), ("de", " . ,\n"), ("xx", "a " * 4000), ("xx", "l" * 50_000 + " a a"), rows[0], rows[0], rows[0],
                   ("é", "p q " * 30), ("en", "new york new\x0byork")]


@pytest.mark.parametrize("sizes,min_count,cover,top", [((2, 3), 10, 50, 2000), ((2, 4), 6, 80, 15), ((3, 3), 2, 50, 40)])
def test_against_brute_force(spark, monkeypatch, sizes, min_count, cover, top):
    monkeypatch.setattr(c, "SHARD_BYTES", 5_000)
    monkeypatch.setattr(c, "SALT", 3)
    rows = odd_rows()
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, lang string, text string") \
        .selectExpr("*", "1 as n", "2 as size", "'x' as phrase", "3 as shard")
    assert rows_of(c.collocations(df, sizes, min_count, cover, top), *COLUMNS) == brute(rows, sizes, min_count, cover, top)


def test_summary_keeps_every_frequent_key():
    """Counters are few, counts are taken off many times, and no frequent key is lost."""
    rng = np.random.default_rng(13)
    for trial in range(20):
        n, min_count = int(rng.integers(100, 20_000)), int(rng.integers(2, 30))
        data = (rng.zipf(1.2, n) % 5_000).astype(np.uint32)
        s = c.Summary(n // min_count + 1)
        for part in np.array_split(data, 23):
            s.add(*np.unique(part, return_counts=True))
        left = set(s.survivors(min_count).tolist())
        key, count = np.unique(data, return_counts=True)
        assert set(key[count >= min_count].tolist()) <= left
        assert s.taken < min_count and len(s.key) <= s.capacity
        true = dict(zip(key.tolist(), count.tolist()))
        assert all(x <= true[k] <= x + s.taken for k, x in zip(s.key.tolist(), s.count.tolist()))


def test_packed_numbers_come_back():
    x = np.array([0, 1, 127, 128, 16383, 16384, (1 << 21) - 1, 1 << 21, 1 << 28, (1 << 32) - 1, 5], np.uint32)
    assert c.expand(c.squeeze(x)).tolist() == x.tolist() and c.expand(c.squeeze(x[:0])).tolist() == []
    assert c._keys(c._steps(np.sort(x))).tolist() == sorted(x.tolist())


def test_a_shard_is_packed_in_little_memory():
    """Cells hold all n-grams of the shard, and the step takes some bytes for each, not copies of all."""
    rng = np.random.default_rng(13)
    letters = rng.integers(0x61, 0x7B, (6_000, 250, 4), dtype=np.uint8)
    letters[:, :, 3] = 0x20
    texts = [x.tobytes().decode() for x in letters]
    table = pa.table([["en"] * len(texts), texts, pa.array([3] * len(texts), pa.int32())], ["lang", "text", "shard"])
    c._send(7, 24, 3)(table.slice(0, 10))
    tracemalloc.start()
    cells = c._send(7, 24, 3)(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 * 6_000_000
    want = np.concatenate([k for _, g in c._each(table, 3) for k in g.key.values()])
    target, low = c._place(want, 7, 24)
    assert sorted(cells["target"].to_pylist()) == list(range(7)) and set(cells["shard"].to_pylist()) == {3}
    for r in cells.to_pylist():
        key, count = np.unique(low[target == r["target"]], return_counts=True)
        assert r["mass"] == count.sum() and (c._keys(r["cell"]) == key).all() and (c.expand(r["times"]) == count).all()
    assert len(c._send(7, 24, 3)(table.slice(0, 1).set_column(1, "text", pa.array([" . "])))) == 0


def test_counters_do_not_change_the_result(spark, monkeypatch):
    """With a capacity just above mass / threshold the summaries lose counts, not phrases."""
    rows = odd_rows()
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, lang string, text string")
    monkeypatch.setattr(c, "SHARD_BYTES", 3_000)
    monkeypatch.setattr(c, "SLACK", 1)
    assert rows_of(c.collocations(df, (2, 3), 40), *COLUMNS) == brute(rows, (2, 3), 40)


def test_large_counts_are_exact(spark):
    """Products beyond 64 bits."""
    text = "deep sea " * 20_000
    rows = [("en", text + ". sea deep")] * 3
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, lang string, text string")
    assert rows_of(c.collocations(df), *COLUMNS) == brute(rows)


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, "en", "a b")], "doc_id long, lang string, text string")
    assert c.collocations(df.limit(0)).collect() == [] and c.collocations(df).collect() == []


def test_query_on_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("lang", "text").collect()]
    assert rows_of(QUERIES["op13_collocations"](spark, SF001), *COLUMNS) == brute(rows)
