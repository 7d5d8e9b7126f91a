"""Connected components of an undirected graph by alternating large-star and
small-star steps (Kiveris et al., "Connected Components in MapReduce and
Beyond", 2014).  Every step is a grouped minimum and a join on one key, so no
component is ever gathered in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step.  ``edges``: ``u, v`` with ``u > v``, distinct."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"),
                                                         F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = (both.join(least, "u").filter("v > u")
               .select(F.col("v").alias("u"), F.col("m").alias("v")))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        joined = edges.join(least, "u")
        out = (joined.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
               .union(least.select("u", F.col("m").alias("v"))))
    return out.filter("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges``: ``u, v`` (any order, repeats and loops allowed).  Returns
    ``node, root`` for every node that is not its own root; the root is the
    smallest node of the component."""
    now = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                      .filter("u != v").distinct(), "links")
    mark = None
    while True:
        now = materialize(_star(_star(now, True), False), "links")
        row = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v") % 1000003).alias("h"),
                      F.bit_xor(F.xxhash64("v", "u")).alias("x")).first()
        if (row.n, row.h, row.x) == mark or row.n == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = (row.n, row.h, row.x)
