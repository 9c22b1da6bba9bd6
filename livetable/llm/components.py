"""Connected components of an edge table by repeated contraction.

Each round sends every vertex to the smallest vertex next to it (or itself) and
rewrites the edges; edges inside a merged vertex vanish.  A star is gone after one
round, a path of n edges after about log n.  Nothing is gathered on the driver but
the number of edges left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .store import settle


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(vertex, root) for every vertex of ``edges``; root is one vertex of its
    component, the same for all of them.  Nulls are no vertices."""
    e = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).dropna().filter("u <> v")
    e = settle(e.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    label = None
    while e.head(1):
        both = e.union(e.select(F.col("v"), F.col("u")))
        step = settle(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("to")))
        if label is None:
            label = step.select(F.col("u").alias("vertex"), F.col("to").alias("root"))
        else:
            label = settle(label.join(step, label.root == step.u, "left")
                           .select("vertex", F.coalesce("to", "root").alias("root")))
        a, b = step.select("u", F.col("to").alias("a")), step.select(F.col("u").alias("v"), F.col("to").alias("b"))
        e = settle(e.join(a, "u").join(b, "v").filter("a <> b")
                   .select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct())
    if label is None:
        label = e.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
    return label
