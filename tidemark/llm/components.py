"""Connected components of a graph given by its links, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import written


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) for every node of the links (a, b).

    Alternating stars: each node hands the smallest of its neighbours to its larger ones, then to its smaller ones.
    A component becomes a star around its smallest node after a number of rounds that grows with the logarithm of its
    size. Each round is written to the shared folder. Loops (a = b) only make their node known.
    """
    nodes = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    pairs = (
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    pairs = written(pairs, "links")
    before = None
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        smallest = written(smallest, "large-star")
        large = both.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = written(large.distinct(), "large-star-links")
        smallest = written(pairs.groupBy("u").agg(F.min("v").alias("m")), "small-star")
        small = pairs.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = written(small.union(smallest.select("u", F.col("m").alias("v"))).distinct(), "small-star-links")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return nodes.join(pairs.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )
