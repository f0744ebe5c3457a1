"""Connected components of a link table by rounds of large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import forget, let_go, stored


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """node, root for every node of links (a, b): root is the least node of its component. Each round is two aggregations and two joins on nodes; the number of rounds grows with the logarithm of the longest path. The driver sees one checksum a round."""
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), f"{name}-0")
    before, k = None, 0
    while True:
        k += 1
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        # stored, so that the join reads exchanges of its own and Spark can split a node of very many links
        least = stored(both.groupBy("v").agg(F.min("u").alias("m")).withColumn("m", F.least("v", "m")), f"{name}-least{k}")
        large = both.where("u > v").join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        large = stored(large, f"{name}-large{k}")
        low = stored(large.groupBy("v").agg(F.min("u").alias("m")), f"{name}-low{k}")
        small = large.join(low, "v").where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u")).unionByName(low.withColumnRenamed("m", "u")).distinct()
        last, edges = edges, stored(small, f"{name}-{k}")
        forget(last, least, large, low)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())
        let_go(edges.sparkSession)
        if now == before:
            break
        before = now
    return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
