"""Connected components of link tables, without any group in one task or on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (smallest node that links reach) for every node of a link but the components' own smallest.

    Links are turned into stars in rounds: every node's larger neighbours are hung to its
    smallest neighbour, then its smaller ones. Rounds grow with the logarithm of the largest
    component; each is written to the shared folder. NULL ends and loops are no links.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    edges, before = stored(edges, tidy=True), None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = state
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("m", "u").alias("m"))
        large = both.join(lowest, F.col("u") == F.col("k")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        small = large.join(down, F.col("u") == F.col("k"))
        edges = stored(small.select("v", "m").union(down.select("k", "m")).toDF("u", "v").filter("u <> v").distinct(), tidy=True)
