"""URL filter over a sorted digest array.

A rule ``host/path`` fits its host and all subdomains, where the url's path starts with
the rule's path; the longest rule that fits wins (of two equally long ones the one with
the longer host; block before allow for one rule with both).  The rules are one file:
sorted 64-bit xxhash keys of the rules and of their hosts, the full strings and the
actions.  Each task memory-maps it, probes the keys of a url's host suffixes by
vectorised binary search, then those of suffix and path prefix for the path lengths
that the host's rules have, and compares the stored string with the url's before a
rule counts, so colliding keys do no harm.

Rules are cut into shards of at most ``SHARD_BYTES``, each broadcast by itself; urls pass
shard after shard in one stage and keep the longest rule.

Url parts: host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end,
with A-Z lower-cased; path is what follows up to ``?``, ``#`` or the end.  A null url and
one without ``://`` have neither and no rule fits.  Null rules or actions are no rules.
Repeated urls are judged one by one, repeated rules count once; an empty table gives no rows, no
rules judge nothing.  A url of any length is one row.  Other columns are ignored.
"""

from __future__ import annotations

import mmap
import os
import struct
import tempfile

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

SHARD_BYTES = 16 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) by the rules above."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def build_file(rules: list[tuple[str, str]]) -> bytes:
    """The digest file of (rule, action) pairs."""
    chosen: dict[tuple[str, str], str] = {}
    for rule, action in sorted(rules):
        host, slash, path = rule.partition("/")
        chosen.setdefault((host, slash + path), action)  # 'allow' sorts before 'block'
        if action == "block":
            chosen[host, slash + path] = action
    keys = sorted((xxhash.xxh64_intdigest((h + p).encode()), h, p, a) for (h, p), a in chosen.items())
    strings = [(h + p).encode() for _, h, p, _ in keys]
    hosts: dict[str, set[int]] = {}
    for _, h, p, _ in keys:
        hosts.setdefault(h, set()).add(len(p))
    host_keys = sorted((xxhash.xxh64_intdigest(h.encode()), h) for h in hosts)
    names = [h.encode() for _, h in host_keys]
    lengths = [sorted(hosts[h]) for _, h in host_keys]
    arrays = [
        np.array([k[0] for k in keys], np.uint64),
        np.cumsum([0, *map(len, strings)]).astype(np.uint64),
        np.array([k[3] == "block" for k in keys], np.uint64),
        np.array([len(k[1].encode()) for k in keys], np.uint64),
        np.array([k[0] for k in host_keys], np.uint64),
        np.cumsum([0, *map(len, names)]).astype(np.uint64),
        np.cumsum([0, *map(len, lengths)]).astype(np.uint64),
        np.array([n for x in lengths for n in x], np.uint64),
    ]
    head = struct.pack("<8Q", *map(len, arrays))
    return head + b"".join(a.tobytes() for a in arrays) + b"".join(strings) + b"".join(names)


class DigestFile:
    """A digest file, memory-mapped from a task's own temporary file; the file's name
    is removed at once, so nothing stays behind."""

    def __init__(self, data: bytes):
        fd, path = tempfile.mkstemp(prefix="url-rules-")
        try:
            with os.fdopen(fd, "w+b") as f:
                f.write(data)
                f.flush()
                self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        finally:
            os.unlink(path)
        sizes = struct.unpack_from("<8Q", self.map)
        at, arrays = 64, []
        for n in sizes:
            arrays.append(np.frombuffer(self.map, np.uint64, n, at))
            at += 8 * n
        self.keys, self.cut, self.block, self.host_size, self.host_keys, self.host_cut, self.length_cut, self.lengths = arrays
        self.text = at
        self.names = at + int(self.cut[-1])

    def rule(self, k: int) -> bytes:
        return self.map[self.text + int(self.cut[k]):self.text + int(self.cut[k + 1])]

    def _host(self, k: int) -> bytes:
        return self.map[self.names + int(self.host_cut[k]):self.names + int(self.host_cut[k + 1])]

    @staticmethod
    def _probe(sorted_: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(probe, place) of every equal key; several places where keys collide."""
        lo = np.searchsorted(sorted_, keys, side="left")
        n = np.searchsorted(sorted_, keys, side="right") - lo
        probe = np.repeat(np.arange(len(keys)), n)
        ends = np.cumsum(n)
        return probe, np.repeat(lo - (ends - n), n) + np.arange(len(probe))

    def longest(self, hosts: list[str], paths: list[str]) -> list[tuple[int, int, int] | None]:
        """For each url the longest fitting rule: (bytes, host bytes, place)."""
        best: list[tuple[int, int, int] | None] = [None] * len(hosts)
        suffix, owner = [], []
        for u, host in enumerate(hosts):
            if host:
                parts = host.encode()
                at = -1
                while True:
                    suffix.append(parts[at + 1:])
                    owner.append(u)
                    at = parts.find(b".", at + 1)
                    if at < 0:
                        break
        if not suffix or not len(self.keys):
            return best
        digest = np.fromiter(map(xxhash.xxh64_intdigest, suffix), np.uint64, len(suffix))
        full, whose = [], []
        for s, k in zip(*(x.tolist() for x in self._probe(self.host_keys, digest))):
            if self._host(k) == suffix[s]:
                path = paths[owner[s]]
                for n in self.lengths[int(self.length_cut[k]):int(self.length_cut[k + 1])].tolist():
                    if n <= len(path):
                        full.append((suffix[s], path[:n].encode()))
                        whose.append(owner[s])
        if not full:
            return best
        digest = np.fromiter((xxhash.xxh64_intdigest(h + p) for h, p in full), np.uint64, len(full))
        for q, k in zip(*(x.tolist() for x in self._probe(self.keys, digest))):
            host, path = full[q]
            if self.rule(k) == host + path and int(self.host_size[k]) == len(host):
                found = (len(host) + len(path), len(host), k)
                if best[whose[q]] is None or found[:2] > best[whose[q]][:2]:
                    best[whose[q]] = found
        return best


_open: dict[int, DigestFile] = {}


def _judge(source):
    def run(batches):
        data = source.value
        key = xxhash.xxh64_intdigest(data)
        if key not in _open:
            _open.clear()
            _open[key] = DigestFile(data)
        rules = _open[key]
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            rule, action, size = (batch.column(c).to_pylist() for c in ("rule", "action", "size"))
            for u, found in enumerate(rules.longest(hosts, paths)):
                if found and (size[u] is None or (found[0] << 20) + found[1] > size[u]):
                    size[u] = (found[0] << 20) + found[1]
                    rule[u], action[u] = rules.rule(found[2]).decode(), "block" if rules.block[found[2]] else "allow"
            cols = {"rule": pa.array(rule, pa.string()), "action": pa.array(action, pa.string()), "size": pa.array(size, pa.int64())}
            yield pa.RecordBatch.from_arrays([cols.get(c, batch.column(c)) for c in batch.schema.names], names=batch.schema.names)
    return run


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", carry: tuple[str, ...] = ("page_id",),
                default: str = "allow") -> DataFrame:
    """(*carry, host, path, rule, verdict) for every row of ``pages``.

    ``rules``: columns rule (``host/path``) and action (allow or block).  Where no rule
    fits, rule is null and the verdict is ``default``.
    """
    spark = pages.sparkSession
    host, path = url_parts(F.col(url).cast("string"))
    names = {c: f"carry_{k}" for k, c in enumerate(carry)}
    rows = pages.select(*[F.col(c).alias(a) for c, a in names.items()], host.alias("host"), path.alias("path"),
                        F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("action"),
                        F.lit(None).cast("long").alias("size"))
    listed = rules.select(F.col("rule").cast("string"), F.col("action").cast("string")).dropna().distinct()
    total = listed.agg(F.sum(F.octet_length("rule") + 64)).first()[0] or 0
    shards = max(1, -(-int(total) // (SHARD_BYTES // 2)))
    for k in range(shards):
        # One bounded shard at a time reaches the driver.
        part = listed.filter(F.pmod(F.xxhash64("rule"), F.lit(shards)) == k).collect()
        source = spark.sparkContext.broadcast(build_file([(r["rule"], r["action"]) for r in part]))
        rows = rows.mapInArrow(_judge(source), rows.schema)
    return rows.select(*[F.col(a).alias(c) for c, a in names.items()], "host", "path", "rule",
                       F.coalesce("action", F.lit(default)).alias("verdict"))
