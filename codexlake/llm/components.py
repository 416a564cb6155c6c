"""Connected components of a graph given as links, by alternating large-star and small-star steps.

Every step is a grouped minimum and an equi-join, so no group is gathered in one task: minima are combined before the
shuffle, and the join reads two written tables, whose hot keys adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import forget, written


def _star(edges: DataFrame, small: bool, n: int) -> DataFrame:
    """One step. edges: (u, v), u > v, at most n. Large star: all neighbours; small star: the lower ones only."""
    around = edges if small else edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = written(around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), 2 * n)
    joined = around.join(least, "u")
    if small:
        pairs = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        pairs = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    out = written(pairs.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), 2 * n)
    forget(least)
    return out


def components(links: DataFrame) -> DataFrame:
    """links: (a, b) integers, in either direction, repeats and loops allowed; nulls link nothing.

    Returns (node, component) for every node of a proper link; component is the least node reachable.
    """
    edges = written(
        links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v")).distinct()
    )
    mark = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    before = mark(edges)
    while before[0]:
        large = _star(edges, False, before[0])
        after = _star(large, True, 2 * before[0])
        now = mark(after)
        forget(edges, large)
        edges = after
        if now == before:
            break
        before = now
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
