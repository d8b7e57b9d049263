"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.session import materialize


def _smallest(pairs: DataFrame) -> DataFrame:
    """``u``, ``v`` and ``low``, the smallest of u and all its v."""
    low = pairs.groupBy("u").agg(F.min("v").alias("low"))
    return pairs.join(low, "u").withColumn("low", F.least("u", "low"))


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for every linked node.

    ``links`` has bigint columns ``a`` and ``b``.  A round points the larger neighbours of
    each node at its smallest neighbour, and then the smaller ones; the number of rounds
    grows with the logarithm of the longest path.  Minima are reduced before the shuffle,
    and the joins back to the links are ones in which Spark splits hot nodes.  Each round is
    a table in the shared folder.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                        .filter("u <> v").distinct(), "links")
    before = None
    while True:
        mark = tuple(edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("bigint")),
                               F.sum(F.xxhash64("v", "u") % 1000003)).first())
        if mark == before or mark[0] == 0:
            break
        before = mark
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_smallest(both).filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
                 .distinct())
        small = _smallest(large)
        edges = materialize(
            small.filter("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
            .unionByName(small.select("u", F.col("low").alias("v"))).distinct(), "links")
    roots = edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    return roots.unionByName(roots.select(F.col("component").alias("node"), "component").distinct())
