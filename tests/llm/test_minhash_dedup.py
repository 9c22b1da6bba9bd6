"""Near-duplicate groups against brute force over all pairs of sets."""

import random

import numpy as np
import pytest

from livetable.llm import minhash_dedup as m
from livetable.llm.store import read

from conftest import SF001, SPACED, lower, rows_of


def sets_of(rows, size):
    out = []
    for _, text in rows:
        w = SPACED.findall(lower(text))
        out.append({tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    return out


def brute(rows, size, percent=80):
    sets, group = sets_of(rows, size), list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None:
                continue
            both = len(sets[a] & sets[b])
            if rows[a][0] == rows[b][0] or (both and 100 * both >= percent * len(sets[a] | sets[b])):
                group[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    out = []
    for k, (i, _) in enumerate(rows):
        comp = None if i is None else low[find(k)]
        out.append((i, len(sets[k]), comp, i is None or comp == i))
    return sorted(out, key=str)


COLUMNS = ("doc_id", "n_shingles", "component_id", "kept")


def near_copies(rng, n, words=60):
    """Groups of edited copies, singles, short texts and every odd case."""
    rows, vocabulary = [], [f"w{k}" for k in range(400)]
    for i in range(n):
        if rows and rng.random() < 0.6:
            w = rng.choice(rows)[1].split()
            for _ in range(rng.randint(0, 5)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
        else:
            w = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, words, 2 * words]))]
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("size", [2, 5])
def test_groups_equal_brute_force(spark, size):
    rows = near_copies(random.Random(size), 150)
    odd = [(900, None), (901, ""), (902, " \t\n"), (903, "Ab cd"), (904, "aB CD"), (None, rows[0][1]), (None, None),
           (5, rows[5][1]), (5, rows[5][1]), (6, rows[40][1]), (905, "x" * 5000), (906, "é ü"), (907, "É ü")]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string")
    assert rows_of(m.near_duplicates(df, size=size), *COLUMNS) == brute(rows + odd, size)


def test_large_group_of_near_copies_loses_no_link(spark, monkeypatch):
    """One bucket with many members and several groups; tiny blocks on both sides."""
    monkeypatch.setattr(m, "BLOCK", 16)
    rng = random.Random(3)
    base = [f"w{k}" for k in range(80)]
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(50)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(m.near_duplicates(df, size=2), *COLUMNS) == brute(rows, 2)


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, node string, band int")
    assert m.near_duplicates(empty, size=2).collect() == []
    df = spark.createDataFrame([(1, "a b c", "q", 3), (2, "a b c", None, 4)], "doc_id long, text string, node string, band int")
    assert rows_of(m.near_duplicates(df, size=2), *COLUMNS) == [(1, 2, 1, True), (2, 2, 1, False)]


def test_signature_estimates_similarity():
    mult = m.multipliers(2000)
    x = np.random.default_rng(1).integers(0, 2**63, 1500, dtype=np.uint64)
    a, b = m.signature(x[:1000], mult), m.signature(x[500:], mult)
    assert abs((a == b).mean() - 1 / 3) < 0.04


def test_posterior_bound():
    """Fewest agreeing values rise with n, and a pair at the threshold passes all tests."""
    tests = m.least_agreeing(0.8)
    shares = [least / n for n, least in tests]
    assert shares == sorted(shares) and 0.6 < shares[-1] < 0.8
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**16, (3000, m.VALUES)).astype(np.uint16)
    b = np.where(rng.random(a.shape) < 0.8, a, a + np.uint16(1))
    assert len(m.surviving(a, b, tests)) == 3000


def test_query_equals_brute_force_on_small_table(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents", "doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    from livetable.llm.queries import QUERIES
    assert rows_of(QUERIES["op1_minhash_dedup"](spark, "/root/testdata/sf0.001"), *COLUMNS) == brute(rows, 2)
