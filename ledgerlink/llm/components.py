"""Connected components of a table of links, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlink.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """node, label (the component's smallest node) of every node of links (a, b); order and repeats don't matter.

    Alternates two rounds: each node hands its smallest neighbour to the larger ones, then to the
    smaller ones and itself, until all links point to labels.  Hubs are minima by partial aggregation
    and a join with one row a node, so none is gathered in one task.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = stored(links.select(high.alias("u"), low.alias("v")).filter("u != v").distinct(), "links")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("label"))
            ).distinct()
        before = state
        # All links of a node, either way; larger neighbours go to the smallest one.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("least"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        large = stored(large.filter("u != v").distinct(), "links")
        # Smaller neighbours and the node itself go to the smallest neighbour.
        least = large.groupBy("u").agg(F.min("v").alias("least"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        own = least.select("u", F.col("least").alias("v"))
        edges = stored(small.unionByName(own).filter("u != v").distinct(), "links")
