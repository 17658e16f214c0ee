"""Connected components of a links table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barstream.session import staged


def _mark(edges: DataFrame):
    row = edges.agg(
        F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % 1000003)
    ).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (columns ``a``, ``b``).

    Each round points all neighbours of a node at the smallest of them, first the
    larger and then the smaller ones, and drops repeats; the rounds needed grow with
    the logarithm of the longest chain.  Every round is written to the shared folder.
    """
    edges = staged(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.where("u <> v").distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.where("u <> v").unionByName(least.withColumnRenamed("m", "v"))
        edges = staged(small.distinct(), "small-star")
        before, mark = mark, _mark(edges)
        if before == mark:
            break
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.unionByName(leaves.select(F.col("root").alias("node"), "root").distinct())
