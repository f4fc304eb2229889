"""Connected components by alternating stars, in tables of the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def components(edges: DataFrame, folder: str) -> DataFrame:
    """(node, root) for every node of edges (a, b): root is the smallest node that links lead to. Roots themselves are left out.

    Each round joins neighbours to the smallest one known, so the number of
    rounds grows with the logarithm of a component's size; each round's edges
    are a table, and the driver sees counts only.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    e = common.written(e, f"{folder}/0")
    before, turn = None, 0
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        if not now[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before, turn = now, turn + 1
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = common.written(small.union(least.select("u", F.col("m").alias("v"))).distinct(), f"{folder}/{turn}")
