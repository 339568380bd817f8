"""Connected components of an edge list by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import materialize, materialize_measured


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b); the label is the smallest node reachable.

    Large and small stars are contracted in turn until every edge points at its label. Each round
    needs work in proportion to the edges and halves the depth; the number of rounds grows with
    the logarithm of the nodes. Rounds are written to the scratch folder, which cuts the lineage.
    Neighbours are reduced to their minimum before they are shuffled, and the joins on a hub are
    plain equality joins that adaptive execution splits.
    """
    # every edge points from the larger node to the smaller
    edges = materialize(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(),
        "edges",
    )
    mark = None
    while True:
        # large star: larger neighbours move to the smallest node around
        both = _both_ways(edges)
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = (
            both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        )
        large = materialize(large, "large-star")
        # small star: smaller neighbours and the node itself move there as well
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        moved = large.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        own = least.select("a", F.col("least").alias("b"))
        edges, found = materialize_measured(
            moved.unionByName(own).filter("a != b").distinct(),
            "small-star",
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("sum"),
        )
        if mark == (found.get("n"), found.get("sum")):
            break
        mark = (found.get("n"), found.get("sum"))
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        roots.select("node", F.col("node").alias("label"))
    )
