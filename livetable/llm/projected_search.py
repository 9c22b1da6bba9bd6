"""Approximate nearest neighbours by stable projections and kd-trees.

Vectors are projected to ``M`` Gaussian (2-stable) directions: the squared projected
distance of two vectors is their squared distance times a chi-square variable with M
degrees of freedom.  A query walks its projected neighbours in order of distance, in
steps of one kd-tree leaf, verifies them on the original vectors, and stops once the
chi-square test holds: no vector closer than the k-th best so far would, with
probability ``SURE``, lie farther out than the next leaf.  So every true neighbour is
found with probability ``SURE`` or more.

On the cluster, the top of the kd-tree (built from a sample of at most ``SAMPLE``
projected vectors) deals all vectors into cells; cells with many vectors are salted
into chunks of about ``CHUNK`` rows, each with a kd-tree of its own.  A query first
searches its own cell; the k-th distance found there and the same test then name the
other cells it must visit.  Each visit returns k rows; the k best of all are kept.

Distances are Euclidean, in double precision, on the original vectors; ties go to the
smaller vec_id.  Vectors that are null, empty, zero or hold null or non-finite numbers
take no part, nor do rows with a null vec_id; a query meets vectors of its own length
only, and not those of its own vec_id.  Rows that share a vec_id count once, with the
nearest of them.  An empty table, and one without queries, gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .store import settle

M = 8               # projected dimensions (even)
SURE = 0.97
SAMPLE = 20_000
CHUNK = 16_384
LEAF = 128
SLACK = 1e-12       # of the query's squared length: rounding of squared projected distances
SEED = 90


def chi_square(x: float, m: int = M) -> float:
    """P(chi-square with m (even) degrees of freedom <= x)."""
    half, term, total = x / 2, 1.0, 0.0
    for i in range(m // 2):
        total += term
        term *= half / (i + 1)
    return 1 - math.exp(-half) * total


def reach(sure: float = SURE, m: int = M) -> float:
    """Squared projected distance, in units of a squared distance, that a vector at that
    distance stays within with probability ``sure``."""
    lo, hi = 0.0, 1000.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square(mid, m) < sure else (lo, mid)
    return hi


def projection(length: int, m: int = M) -> np.ndarray:
    return np.random.default_rng([SEED, length]).standard_normal((length, m))


class Splits:
    """The top of the kd-tree: node i has children 2i+1 and 2i+2; leaves are cells."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        self.axis = np.zeros(2**depth - 1, np.int64)
        self.value = np.full(2**depth - 1, np.inf)
        rows = {0: sample}
        for node in range(2**depth - 1):
            part = rows.pop(node)
            if len(part):
                axis = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
                value = float(np.median(part[:, axis]))
                self.axis[node], self.value[node] = axis, value
                right = part[:, axis] > value
            else:
                right = np.zeros(0, bool)
            rows[2 * node + 1], rows[2 * node + 2] = part[~right], part[right]

    def cell(self, z: np.ndarray) -> np.ndarray:
        node = np.zeros(len(z), np.int64)
        for _ in range(self.depth):
            right = z[np.arange(len(z)), self.axis[node]] > self.value[node]
            node = 2 * node + 1 + right
        return node - (2**self.depth - 1)

    def near(self, z: np.ndarray, limit: float) -> list[int]:
        """Cells whose box lies within the squared distance ``limit`` of z."""
        out, todo = [], [(0, np.zeros(len(z)))]
        while todo:
            node, off = todo.pop()
            if node >= len(self.axis):
                out.append(node - len(self.axis))
                continue
            a, v = self.axis[node], self.value[node]
            gap = z[a] - v
            far = off.copy()
            far[a] = gap * gap if abs(gap) < math.inf else math.inf
            side = int(gap > 0)
            todo.append((2 * node + 1 + side, off))
            if max(far[a], off[a]) + far.sum() - far[a] <= limit:
                far[a] = max(far[a], off[a])
                todo.append((2 * node + 2 - side, far))
        return out


class Tree:
    """A kd-tree over projected vectors, with boxes; leaves hold at most LEAF rows."""

    def __init__(self, z: np.ndarray):
        self.order = np.arange(len(z))
        self.nodes: list[tuple] = []    # (low corner, high corner, begin, end, left, right)
        self._build(z, 0, len(z))

    def _build(self, z: np.ndarray, a: int, b: int) -> int:
        rows = self.order[a:b]
        part = z[rows]
        low, high = part.min(axis=0), part.max(axis=0)
        k = len(self.nodes)
        self.nodes.append(None)
        left = right = -1
        if b - a > LEAF:
            axis = int(np.argmax(high - low))
            self.order[a:b] = rows[np.argsort(part[:, axis], kind="stable")]
            mid = (a + b) // 2
            left, right = self._build(z, a, mid), self._build(z, mid, b)
        self.nodes[k] = (low, high, a, b, left, right)
        return k

    def leaves(self, q: np.ndarray):
        """(squared distance of the box, rows) of the leaves, nearest first."""
        heap = [(self._gap(0, q), 0)]
        while heap:
            gap, k = heapq.heappop(heap)
            _, _, a, b, left, right = self.nodes[k]
            if left < 0:
                yield gap, self.order[a:b]
            else:
                heapq.heappush(heap, (self._gap(left, q), left))
                heapq.heappush(heap, (self._gap(right, q), right))

    def _gap(self, k: int, q: np.ndarray) -> float:
        low, high = self.nodes[k][0], self.nodes[k][1]
        d = np.maximum(np.maximum(low - q, q - high), 0)
        return float(d @ d)


def nearest(tree: Tree, z: np.ndarray, x: np.ndarray, ids: np.ndarray, q_id: int, q: np.ndarray, qz: np.ndarray, k: int,
            bound: float, factor: float) -> list[tuple[float, int]]:
    """The k nearest found: (distance, id), ties by id; ``bound``: a k-th distance
    known from elsewhere."""
    best: list[tuple[float, int]] = []
    kth = bound
    slack = SLACK * float(q @ q)
    for gap, rows in tree.leaves(qz):
        if gap > factor * kth * kth + slack:
            break
        rows = rows[ids[rows] != q_id]
        d = z[rows] - qz
        rows = rows[np.einsum("ij,ij->i", d, d) <= factor * kth * kth + slack]
        if not len(rows):
            continue
        e = x[rows] - q
        dist = np.sqrt(np.einsum("ij,ij->i", e, e))
        merged: dict[int, float] = {i: s for s, i in best}
        for s, i in zip(dist.tolist(), ids[rows].tolist()):
            if s <= kth and s < merged.get(i, math.inf):
                merged[i] = s
        best = sorted((s, i) for i, s in merged.items())[:k]
        if len(best) == k:
            kth = min(kth, best[-1][0])
    return best


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def _deal(source, length: int):
    """The cell of each vector, by its projection."""
    def run(batches):
        splits = source.value
        a = projection(length)
        for batch in batches:
            if batch.num_rows:
                z = _matrix(batch.column("x")) @ a
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("x"), pa.array(splits.cell(z).astype(np.int32))],
                                                 names=["id", "x", "cell"])
    return run


def _more_cells(source, length: int, factor: float):
    """The other cells each query must visit, given its k-th distance so far."""
    def run(batches):
        splits = source.value
        a = projection(length)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"))
            z = x @ a
            own = batch.column("cell").to_numpy()      # computed anew, rounding may name another
            kth = batch.column("kth").to_numpy(zero_copy_only=False)
            row, cell = [], []
            for k in range(len(x)):
                limit = math.inf if np.isnan(kth[k]) else factor * kth[k] ** 2 + SLACK * float(x[k] @ x[k])
                for c in splits.near(z[k], limit):
                    if c != own[k]:
                        row.append(k)
                        cell.append(c)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id").take(at), batch.column("x").take(at), pa.array(cell, pa.int32()),
                                              batch.column("kth").take(at)], names=["id", "x", "cell", "kth"])
    return run


def _visit(length: int, k: int, factor: float):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out_q, out_i, out_s = [], [], []
        if len(rows) and len(queries):
            a = projection(length)
            x, ids = _matrix(rows["x"]), rows["id"].to_numpy()
            z = x @ a
            tree = Tree(z)
            q, q_ids, kth = _matrix(queries["x"]), queries["id"].to_numpy(), queries["kth"].to_numpy()
            qz = q @ a
            for n in range(len(q)):
                bound = math.inf if np.isnan(kth[n]) else float(kth[n])
                for s, i in nearest(tree, z, x, ids, int(q_ids[n]), q[n], qz[n], k, bound, factor):
                    out_q.append(int(q_ids[n]))
                    out_i.append(i)
                    out_s.append(s)
        return pa.table({"query_id": pa.array(out_q, pa.int64()), "vec_id": pa.array(out_i, pa.int64()), "score": pa.array(out_s, pa.float64())})
    return run


QUERY_BLOCK = 32_768   # queries of one cell that are handled together


def search(vectors: DataFrame, is_query: Callable[[Column], Column], k: int = 10, vec_id: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is a query (``is_query`` of
    the id column) its k nearest other vectors found."""
    x = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), x.alias("x")) \
        .filter(F.col("id").isNotNull() & F.col("x").isNotNull()) \
        .filter(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("x", lambda v: v != 0))
    flagged = rows.withColumn("asks", F.coalesce(is_query(F.col("id")), F.lit(False)))
    lengths = flagged.groupBy(F.size("x").alias("n")).agg(F.count(F.lit(1)).alias("rows"), F.max("asks").alias("asked")).collect()
    spark, factor = vectors.sparkSession, reach()
    found = None
    for info in lengths:    # one pass for each vector length that queries have
        if info["asked"]:
            part = flagged.filter(F.size("x") == info["n"])
            got = _search(spark, part, int(info["n"]), int(info["rows"]), k, factor)
            found = got if found is None else found.union(got)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    by = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return once.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _search(spark, part: DataFrame, length: int, rows: int, k: int, factor: float) -> DataFrame:
    depth = min(12, max(0, math.ceil(math.log2(max(1, rows) / CHUNK))))
    share = min(1.0, SAMPLE / max(1, rows))
    sample = part.select("id", "x").filter(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 30)) < int(share * (1 << 30))).select("x") \
        .limit(2 * SAMPLE).toPandas() if depth else None
    z = np.array(sample["x"].tolist(), np.float64).reshape(-1, length) @ projection(length) if depth else np.zeros((0, M))
    source = spark.sparkContext.broadcast(Splits(z, depth))     # at most 4095 inner nodes

    dealt = settle(part.select("id", "x").mapInArrow(_deal(source, length), "id long, x array<double>, cell int"))
    sizes = {r["cell"]: r["count"] for r in dealt.groupBy("cell").count().collect()}    # at most 4096 cells
    chunks = F.create_map(*[F.lit(v) for c, n in sizes.items() for v in (int(c), max(1, -(-int(n) // CHUNK)))]) if sizes else None
    salted = dealt.withColumn("chunk", F.pmod(F.xxhash64("id"), F.coalesce(chunks[F.col("cell")], F.lit(1))).cast("int"))
    asking = settle(part.filter("asks").select("id", "x").mapInArrow(_deal(source, length), "id long, x array<double>, cell int"))

    def visit(queries: DataFrame) -> DataFrame:
        blocks = max(1, -(-n_queries // QUERY_BLOCK))
        each = queries.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.coalesce(chunks[F.col("cell")], F.lit(1)) - 1))) \
            .withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
        met = each.select(F.col("cell").alias("c"), F.col("chunk").alias("h"), F.col("block").alias("b")).distinct()
        here = salted.join(met, [salted.cell == met.c, salted.chunk == met.h]) \
            .select("cell", "chunk", F.col("b").alias("block"), "id", "x")
        return here.groupBy("cell", "chunk", "block").cogroup(each.select("cell", "chunk", "block", "id", "x", "kth").groupBy("cell", "chunk", "block")) \
            .applyInArrow(_drop_keys(_visit(length, k, factor)), "query_id long, vec_id long, score double")

    n_queries = asking.count()
    first = settle(visit(asking.withColumn("kth", F.lit(float("nan")))))
    if depth == 0:
        return first
    kth = first.groupBy("query_id", "vec_id").agg(F.min("score").alias("score")).withColumn(
        "r", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))) \
        .filter(F.col("r") == k).select(F.col("query_id").alias("id"), F.col("score").alias("kth"))
    more = asking.join(kth.groupBy("id").agg(F.min("kth").alias("kth")), "id", "left") \
        .select("id", "x", "cell", F.coalesce("kth", F.lit(float("nan"))).alias("kth")) \
        .mapInArrow(_more_cells(source, length, factor), "id long, x array<double>, cell int, kth double")
    return first.union(visit(settle(more)))


def _drop_keys(run):
    return lambda rows, queries: run(rows.select(["id", "x"]), queries.select(["id", "x", "kth"]))
