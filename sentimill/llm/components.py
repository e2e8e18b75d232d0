"""Connected components of a table of links, by alternating star contractions.

Each round joins the links with the smallest neighbour of each node (large star: larger
neighbours move to the smallest one; small star: smaller neighbours and the node itself
do) until the links form stars. A round is one grouped minimum, which combines inside the
tasks first, and one join on the node, whose hot keys the adaptive skew join splits. The
links of each round are written to the shared folder, so a lost executor repeats one round
at most. Links and labels never leave the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _star(pairs: DataFrame, keep_self: bool) -> DataFrame:
    """``pairs`` (u, v): every v, and u itself if ``keep_self``, linked to u's smallest."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = pairs.join(least, "u")
    if keep_self:
        out = moved.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        out = moved.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return out.where("a <> b").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for the nodes of ``links``; component is its smallest node.

    Nulls, self-links and repeated links are allowed and change nothing; an empty table
    gives an empty table. Nodes must be orderable; nodes without a link do not appear.
    """
    e = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    e = materialize(e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                    "links")
    known = None
    while True:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _star(both, keep_self=False)
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        e = materialize(_star(down, keep_self=True), "links")
        state = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == known:
            break
        known = state
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
