"""URL filter: SQL on the tables, brute force on made rules, collisions."""

import random

import pytest

from livetable.llm import url_filter as u
from livetable.llm.queries import QUERIES, SQL
from oracle_compare import compare

from conftest import SF001


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    r = compare(spark, name, QUERIES[name], SQL[name], SF001)
    assert r["cols_match"] and r["values_match"] and r["spark_rows"] == r["oracle_rows"] > 0, r


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    end = min([path.find(c) for c in "?#" if c in path], default=len(path))
    return host, path[:end]


def brute(url, rules):
    host, path = parts(url)
    best = None
    for rule, action in rules:
        h, slash, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and host and path.startswith(slash + p):
            key = (len(rule.encode()), len(h.encode()), action == "block")
            if best is None or key > best[0]:
                best = (key, rule, action)
    return (host, path, best[1], best[2]) if best else (host, path, None, "allow")


URLS = [None, "", "nothing", "http://", "http:///x", "HTTP://A.B.Com/X?y#z", "x://b.com", "x://b.com/", "x://ab.com/", "x://a.b.com/a/b",
        "x://b.com?/a/", "x://b.com#/a/", "ftp://u@b.com:80/a", "x://ü.b.com/é/a", "x://b.com/" + "a/" * 3000, "a://b.com/://c.com/",
        "x://.b.com/", "x://b.com./", "x://c\n.b.com/a"]


@pytest.mark.parametrize("shard_bytes", [u.SHARD_BYTES, 256])
def test_rules_against_brute_force(spark, monkeypatch, shard_bytes):
    monkeypatch.setattr(u, "SHARD_BYTES", shard_bytes)
    rng = random.Random(4)
    hosts = ["b.com", "com", "a.b.com", "x.a.b.com", "c.org", "ü.b.com"]
    rules = [(h + "/" + p, a) for h in hosts for p, a in (("", "block"), ("a/", "allow"), ("a/b", "block"), ("é/", "allow"))]
    rules = rng.sample(rules, 14) + [("b.com/a/", "block"), ("b.com/a/", "allow")]
    urls = URLS + [f"http://{rng.choice(hosts)}/{rng.choice(['', 'a/', 'a/b/c', 'b', 'é/x'])}" for _ in range(60)]
    pages = spark.createDataFrame([(k, x, "clash") for k, x in enumerate(urls)], "page_id long, url string, rule string")
    table = spark.createDataFrame(rules + [(None, "block"), ("z/", None)], "rule string, action string")
    got = {r["page_id"]: tuple(r)[1:] for r in u.filter_urls(pages, table).collect()}
    assert got == {k: brute(x, rules) for k, x in enumerate(urls)}


def test_colliding_keys_do_no_harm(monkeypatch):
    """With every key equal, only the stored strings decide."""
    class Flat:
        @staticmethod
        def xxh64_intdigest(data):
            return 7
    monkeypatch.setattr(u, "xxhash", Flat)
    rules = u.DigestFile(u.build_file([("a.com/x/", "block"), ("b.com/", "allow"), ("com/", "block")]))
    found = rules.longest(["q.a.com", "b.com", "c.net", "d.com"], ["/x/1", "/", "/", "/x/"])
    assert [f and rules.rule(f[2]).decode() for f in found] == ["a.com/x/", "b.com/", None, "com/"]


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    rules = spark.createDataFrame([], "rule string, action string")
    assert u.filter_urls(pages, rules).collect() == []
    one = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert [tuple(r) for r in u.filter_urls(one, rules).collect()] == [(1, "a.com", "/", None, "allow")]
