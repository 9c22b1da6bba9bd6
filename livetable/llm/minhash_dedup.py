"""MinHash near-duplicate groups with sequential Bayesian verification.

A document's set is its distinct word shingles; documents whose sets have a
Jaccard similarity of at least the threshold are linked, and linked documents
form groups.

1. One pass gives each document its set size, a 128-bit digest of the set and a
   signature of 16-bit minhash values.  Documents with equal sets are one node (the
   smallest doc_id), so exact copies never meet each other.
2. The first values of the signature are cut into bands.  Nodes of one band bucket
   are candidates; each is paired with the bucket's smallest node only.
3. A pair's signatures are compared batch by batch.  Under a uniform prior, after n
   values of which m agree the similarity's posterior is Beta(m+1, n-m+1); the pair
   is dropped once the posterior probability of reaching the threshold falls below
   ``miss``.
4. Survivors are verified on their full sets, exactly; verified pairs give groups.
5. Pairing with the smallest node covers a bucket unless it still holds several
   groups.  In those buckets every node outside the smallest node's group is compared
   with all nodes of other groups, by steps 3 and 4 inside a task, in blocks of
   bounded size; only links are emitted, one for each node and other group.  No
   pair is left out.

Rows: a null doc_id is in no group (component null, kept).  Null, empty and blank
texts have the empty set: linked with nothing.  Rows that share a doc_id count as
one document.  Ties do not arise: a component's name is its smallest doc_id.  An empty table gives
no rows.  A long text is one row of its own, hashed whole.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .components import components
from .spans import LOWER, SPACED, Words, column_bytes, gram_hashes, mix, pieces
from .store import settle

VALUES = 300        # minhash values of a signature
BAND_ROWS, BANDS = 5, 30    # miss of the bands at 0.8: (1 - 0.8^5)^30 = 6.8e-6
BATCH = 30          # values compared between two tests
MISS = 1e-6         # posterior probability at which a pair is dropped
SEED = 20
BLOCK = 4096        # nodes of a bucket that are compared in one task
FILTER_BITS = 1 << 25


def multipliers(values: int = VALUES, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**31, values, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each document; words are lower-cased (A-Z).
    With fewer words than ``size`` the whole sequence is one shingle."""
    for i, j in pieces(offsets):
        w = Words(data, offsets, i, j, LOWER, SPACED)
        h = w.hashes()
        grams = gram_hashes(h, size)
        for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
            if b - a >= size:
                yield np.unique(grams[a:b - size + 1])
            elif b > a:
                yield gram_hashes(h[a:b], b - a, seed=1)
            else:
                yield h[:0]


def signature(shingles: np.ndarray, mult: np.ndarray) -> np.ndarray:
    """16 bits of the minimum of each of the hash functions x -> a*x mod 2^32."""
    low = None
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    for k in range(0, len(x), 2048):
        part = (mult[:, None] * x[None, k:k + 2048]).min(axis=1)
        low = part if low is None else np.minimum(low, part)
    return mix(low.astype(np.uint64)).astype(np.uint16)


def band_keys(sigs: np.ndarray, rows: int = BAND_ROWS, bands: int = BANDS) -> np.ndarray:
    """(documents, bands) 64-bit bucket keys of (documents, values) signatures; the
    lowest byte is the band's number."""
    keys = np.empty((len(sigs), bands), np.uint64)
    for b in range(bands):
        h = np.full(len(sigs), (b + 1) * 0x9E3779B9, dtype=np.uint64)
        for q in range(rows):
            h = mix(h ^ sigs[:, b * rows + q].astype(np.uint64)) + np.uint64(q)
        keys[:, b] = (h & ~np.uint64(0xFF)) | np.uint64(b)
    return keys


def posterior_reach(m: int, n: int, threshold: float) -> float:
    """P(similarity >= threshold | m of n values agree), uniform prior: the lower
    tail up to m of a Binomial(n + 1, threshold)."""
    return sum(comb(n + 1, i) * threshold**i * (1 - threshold)**(n + 1 - i) for i in range(m + 1))


def least_agreeing(threshold: float, miss: float = MISS, batch: int = BATCH, values: int = VALUES) -> list[tuple[int, int]]:
    """For n = batch, 2*batch, ...: (n, fewest agreeing values at which a pair stays)."""
    out = []
    for n in range(batch, values + 1, batch):
        out.append((n, next((m for m in range(n + 1) if posterior_reach(m, n, threshold) >= miss), n)))
    return out


def surviving(a: np.ndarray, b: np.ndarray, tests: list[tuple[int, int]]) -> np.ndarray:
    """Indexes of the row pairs of two signature matrices that pass every test."""
    left, agree, at = np.arange(len(a)), np.zeros(len(a), np.int32), 0
    for n, least in tests:
        agree = agree + (a[left, at:n] == b[left, at:n]).sum(axis=1, dtype=np.int32)
        stay = agree >= least
        left, agree, at = left[stay], agree[stay], n
    return left


def _features(size: int, mult: np.ndarray):
    def run(batches):
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            n, digest, sig = [], [], []
            for s in shingle_sets(data, offsets, size):
                n.append(len(s))
                digest.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sig.append(signature(s, mult).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(sig, pa.binary())], names=["doc_id", "n", "digest", "sig"])
    return run


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), -1)


def _bands(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = band_keys(_matrix(batch.column("sig")))
        node = np.repeat(batch.column("node").to_numpy(zero_copy_only=False), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(node)], names=["band", "node"])


def _prune(tests):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            left = surviving(_matrix(batch.column("sa")), _matrix(batch.column("sb")), tests)
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(left)) for c in ("u", "v")], names=["u", "v"])
    return run


def _verify(size: int, percent: int):
    """Exact test of each pair on the full sets of both texts."""
    def run(batches):
        for batch in batches:
            u, v = batch.column("u"), batch.column("v")
            order = np.argsort(v.to_numpy(zero_copy_only=False), kind="stable")
            ua, va = u.to_pylist(), v.to_pylist()
            ta, tb = batch.column("ta"), batch.column("tb")
            keep, last, big = [], None, None
            for k in order.tolist():
                text = tb[k].as_py()
                if text != last:
                    last, big = text, _one_set(text, size)
                small = _one_set(ta[k].as_py(), size)
                if _linked(small, big, percent):
                    keep.append(k)
            yield pa.RecordBatch.from_arrays([pa.array([ua[k] for k in keep], pa.int64()),
                                              pa.array([va[k] for k in keep], pa.int64())], names=["u", "v"])
    return run


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common > 0 and 100 * common >= percent * (len(a) + len(b) - common)


def _one_set(text: str, size: int) -> np.ndarray:
    data, offsets = column_bytes(pa.array([text], pa.string()))
    return next(iter(shingle_sets(data, offsets, size)))


def _bitmap(ids: np.ndarray) -> np.ndarray:
    return mix(ids.astype(np.int64).view(np.uint64)) & np.uint64(FILTER_BITS - 1)


def _maybe(source):
    """Whether a doc_id may be one of the wanted ones."""
    @F.pandas_udf("boolean")
    def run(ids: pd.Series) -> pd.Series:
        at = _bitmap(ids.fillna(0).to_numpy()).astype(np.int64)
        return pd.Series((source.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0)
    return run


def _wanted(nodes: DataFrame) -> np.ndarray:
    """A bitmap of hashed ids, built by a grouped bit-or.  Its size is fixed, so it may
    be broadcast at any scale; a full one only lets more rows through to the join."""
    @F.pandas_udf("long")
    def place(ids: pd.Series) -> pd.Series:
        return pd.Series(_bitmap(ids.to_numpy()).astype(np.int64))
    words = nodes.select(place("node").alias("at")).groupBy(F.shiftright("at", 6).alias("word")) \
        .agg(F.expr("bit_or(shiftleft(1L, int(at & 63)))").alias("bits")).toPandas()
    out = np.zeros(FILTER_BITS >> 6, np.uint64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def _cross_links(tests, size: int, percent: int):
    """Verified links between different groups of a bucket's block: each probing node
    against the block's nodes, but for pairs that an earlier band has.  One link
    for each node and other group is enough."""
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        node, root, flag = table["node"].to_numpy(), table["root"].to_numpy(), table["flag"].to_numpy()
        sig = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint16).reshape(len(node), -1)
        keys = band_keys(sig)
        here = int(table["band"][0].as_py() & 0xFF)
        sets: dict[int, np.ndarray] = {}

        def members(k: int) -> np.ndarray:
            if k not in sets:
                sets[k] = _one_set(table["text"][k].as_py(), size)
            return sets[k]

        us, vs = [], []
        targets = np.flatnonzero(flag & 1)
        for p in np.flatnonzero(flag & 2).tolist():
            o = targets[root[targets] != root[p]]
            o = o[~(keys[o, :here] == keys[p, :here]).any(axis=1)] if here else o
            o = o[surviving(np.broadcast_to(sig[p], (len(o), sig.shape[1])), sig[o], tests)]
            alike = (sig[o] == sig[p]).sum(axis=1)
            done: set[int] = set()
            for t in o[np.argsort(-alike, kind="stable")].tolist():
                if root[t] not in done and _linked(members(p), members(t), percent):
                    done.add(root[t])
                    us.append(int(node[p]))
                    vs.append(int(node[t]))
        return pa.table({"u": pa.array(us, pa.int64()), "v": pa.array(vs, pa.int64())})
    return run


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    ``size``: words of a shingle; ``percent``: similarity in hundredths from which
    documents are linked; component_id: smallest doc_id of the group; kept: the row
    has that doc_id.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    feats = settle(rows.select("doc_id", "text").mapInArrow(
        _features(size, multipliers()), "doc_id long, n long, digest binary, sig binary"))
    known = feats.filter("doc_id is not null and digest is not null")
    copies = settle(known.groupBy("digest").agg(F.min("doc_id").alias("node")))
    # One signature for each node (rows that share doc_id and set are repeats).
    sigs = settle(known.join(copies, [known.digest == copies.digest, known.doc_id == copies.node])
                  .select("node", "sig").dropDuplicates(["node", "sig"]))
    bands = sigs.mapInArrow(_bands, "band long, node long")
    tests = least_agreeing(percent / 100)

    # Smallest node of each bucket; the count is pre-aggregated, and a hot bucket of
    # the join is split by the adaptive skew join.
    leaders = bands.groupBy("band").agg(F.min("node").alias("lead"), F.count(F.lit(1)).alias("members")).filter("members > 1")
    met = settle(bands.join(leaders, "band").select("band", "node", "lead", "members"))
    star = settle(met.filter("node <> lead").select(F.col("lead").alias("u"), F.col("node").alias("v")).distinct())

    # Texts of the nodes that any pair can hold, by one pass over the documents.
    nodes = settle(star.select(F.col("u").alias("node")).union(star.select("v")).distinct())
    wanted = docs.sparkSession.sparkContext.broadcast(_wanted(nodes))
    found = rows.filter("doc_id is not null").filter(_maybe(wanted)("doc_id"))
    texts = settle(found.join(nodes, found.doc_id == nodes.node).select("node", "text").dropDuplicates(["node", "text"]))
    near = settle(sigs.join(nodes, "node", "left_semi"))

    sa, sb = near.toDF("u", "sa"), near.toDF("v", "sb")
    alive = star.join(sa, "u").join(sb, "v").select("u", "v", "sa", "sb").mapInArrow(_prune(tests), "u long, v long")
    ta, tb = texts.toDF("u", "ta"), texts.toDF("v", "tb")
    links = settle(alive.join(ta, "u").join(tb, "v").select("u", "v", "ta", "tb")
                   .mapInArrow(_verify(size, percent), "u long, v long"))
    label = components(links)

    # Buckets that still hold several groups: one for each set of members, the first.
    crowd = met.filter("members > 2").join(label, F.col("node") == F.col("vertex"), "left") \
        .select("band", "node", "lead", "members", F.coalesce("root", "node").alias("root"))
    mixed = crowd.groupBy("band").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.max(F.expr("if(node = lead, root, null)")).alias("main"),
        F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("a"), F.sum(F.xxhash64("node", F.lit(1)).cast("decimal(20,0)")).alias("b"),
        F.count(F.lit(1)).alias("c")).filter("lo <> hi")
    first = mixed.groupBy("a", "b", "c").agg(F.min(F.struct(F.expr("band & 255"), "band", "main")).alias("m")) \
        .select("m.band", "m.main")
    # Nodes outside the group of the bucket's smallest node probe all others.  Large
    # buckets are cut into blocks on both sides; flag 1: compared with, 2: probes.
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    probes = F.col("root") != F.col("main")
    others = F.filter(F.sequence(F.lit(0), blocks - 1), lambda k: k != F.col("own"))
    place = lambda t, p, flag: F.struct(t.alias("t"), p.alias("p"), flag.cast("int").alias("flag"))
    cells = F.concat(F.array(place(F.col("own"), F.col("own"), F.when(probes, 3).otherwise(1))),
                     F.transform(others, lambda k: place(F.col("own"), k, F.lit(1))),
                     F.when(probes, F.transform(others, lambda k: place(k, F.col("own"), F.lit(2))))
                     .otherwise(F.expr("cast(array() as array<struct<t:int,p:int,flag:int>>)")))
    again = crowd.join(first, "band").withColumn("own", own) \
        .select("band", "node", "root", F.explode(cells).alias("x")).select("band", "node", "root", "x.*") \
        .join(near, "node").join(texts, "node")
    more = settle(again.groupBy("band", "t", "p").applyInArrow(_cross_links(tests, size, percent), "u long, v long"))
    if more.head(1):
        label = components(links.union(more))

    named = copies.join(label, copies.node == label.vertex, "left") \
        .select("digest", F.coalesce("root", "node").alias("root"))
    # Rows that share a doc_id are one document: their sets' groups are one.
    owners = known.select("doc_id", "digest").distinct().join(named, "digest").select("doc_id", "root")
    twice = owners.groupBy("doc_id").agg(F.min("root").alias("u"), F.max("root").alias("v")).filter("u <> v")
    merged = components(twice.select("u", "v"))
    named = named.join(merged, named.root == merged.vertex, "left") \
        .select("digest", F.coalesce(merged.root, named.root).alias("root"))
    lowest = owners.join(merged, owners.root == merged.vertex, "left") \
        .select("doc_id", F.coalesce(merged.root, owners.root).alias("root")) \
        .groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = named.join(lowest, "root").select("digest", "component_id")
    out = feats.select("doc_id", "n", "digest").join(named, "digest", "left")
    comp = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), comp.alias("component_id"),
                      F.coalesce(comp == F.col("doc_id"), F.lit(True)).alias("kept"))
