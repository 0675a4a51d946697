"""Connected components by alternating large-star and small-star steps.

Each step is a grouped minimum and a join on the node, so no task and no driver holds a
component. Every round is written to the shared folder; the loop ends when a round changes
nothing, which takes a number of rounds logarithmic in the length of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsignal.llm.common import written


def local_forest(a, b, n: int):
    """Roots of ``n`` nodes joined by the edges a[i]-b[i] (numpy): min-label with pointer jumping."""
    import numpy as np
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        open_ = ra != rb
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(up := root[root], root):
            root = up
    return root


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.join(low, "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    down = e.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return down.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (u long, v long) -> one row per node with an edge to a smaller one: (node, root).

    ``root`` is the smallest node of the component; roots themselves have no row. Loops,
    repeated and null edges are ignored; no edges give no rows.
    """
    e = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                .distinct(), "edges")
    mark = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    seen = e.agg(F.count(F.lit(1)), mark).first()
    while seen[0]:
        e = written(_small_star(_large_star(e)), "edges")
        now = e.agg(F.count(F.lit(1)), mark).first()
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
