"""Connected components by alternating stars, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wintide.llm.shared import staged


def connected(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) of all nodes but the roots.

    ``links`` has ``a`` and ``b``. Each round hangs every node's larger neighbours, then its smaller ones,
    on the smallest neighbour, until nothing changes; that takes about the logarithm of the longest path.
    Each round is written to the shared folder. The driver sees two numbers per round.
    """
    edges = staged(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        hung = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = staged(hung.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "links")
        state = edges.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")
        ).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
