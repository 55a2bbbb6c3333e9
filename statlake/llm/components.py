"""Connected components of an edge table by alternating large and small stars.

Every round rewires each node's larger neighbours, then its smaller ones, to
its smallest neighbour; the number of rounds grows with the logarithm of the
longest path.  Each half round is an aggregate and a join on node ids.  A
node's neighbours are dealt over ``SALTS`` cells by their hash: minima are
taken per cell, then over the at most ``SALTS`` cells of the node, and the
edges join their cell, so the centre of a large star is many keys and never
one.  Nothing reaches the driver but counts and checksums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statlake.llm import store

SALTS = 64


def _sum(edges: DataFrame) -> tuple:
    h = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h)).first())


def _with_lowest(edges: DataFrame) -> DataFrame:
    """``(u, v, m)``: each edge with the smallest neighbour ``v`` of its ``u``."""
    edges = edges.withColumn("cell", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
    cells = edges.groupBy("u", "cell").agg(F.min("v").alias("m"))
    cells = cells.select("u", "cell", F.min("m").over(Window.partitionBy("u")).alias("m"))
    return edges.join(cells, ["u", "cell"]).select("u", "v", "m")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)``: the smallest
    id that can be reached.  Loops and repeated edges are allowed."""
    e = store.table(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(),
                    "edges")
    nodes = e
    before = None
    for _ in range(max_rounds):
        now = _sum(e)
        if now == before or now[0] == 0:
            break
        before = now
        # large star: every node's larger neighbours go to its smallest one (or itself)
        large = _with_lowest(e.union(e.select("b", "a")).toDF("u", "v")).filter("v > u")
        large = large.select(F.least("u", "m").alias("a"), F.col("v").alias("b"))
        e = store.table(large.filter("a < b").distinct(), "large-star")
        # small star: a node and its smaller neighbours go to the smallest of them
        small = _with_lowest(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        small = small.select(F.col("m").alias("a"), F.explode(F.array("u", "v")).alias("b"))
        e = store.table(small.filter("a < b").distinct(), "small-star")
    else:
        raise RuntimeError("components did not converge")
    roots = nodes.select("a").distinct().join(e.select(F.col("b").alias("a")), "a", "left_anti")
    return e.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        roots.select(F.col("a").alias("node"), F.col("a").alias("component")))
