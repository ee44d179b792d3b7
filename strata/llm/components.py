"""Connected components by alternating large and small stars.

Every round points each node's larger neighbours at the smallest node it
knows, first for all neighbours, then for the smaller ones.  Minima come from
partial aggregates and hubs are ordinary join keys (split by AQE), so no
neighbourhood is ever gathered in one task or on the driver; each round's
edges are written to the shared folder, which keeps the lineage one round deep.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _star(pairs: DataFrame, keep) -> DataFrame:
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return pairs.join(least, "u").filter(keep)


def connected_components(links: DataFrame, files: int | None = None) -> DataFrame:
    """(node, component) for every node of ``links`` (src, dst); component is
    the smallest node of the component.  Runs until nothing changes; each
    round's edges are written to at most ``files`` files."""
    edges = stage(links.filter(F.col("src") != F.col("dst"))
                  .select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct(), "edges", files=files)
    mark = None
    while True:
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        large = (_star(both, F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u != v").distinct())
        nearest = _star(large, F.lit(True))
        small = (nearest.select("u", F.col("m").alias("v"))
                 .union(nearest.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")))
                 .filter("u != v").distinct())
        edges = stage(small, "edges", files=files)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            return edges.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component") \
                .union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        mark = tuple(now)
