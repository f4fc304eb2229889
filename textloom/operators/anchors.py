"""Unique addresses, their check, and the way from old ones to present ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def minted(rows: DataFrame, base: Column, by: list[str], order: list[str], reserved: DataFrame | None = None) -> DataFrame:
    """rows with ``anchor``: base, or base-2, base-3 and so on for homonyms in order, within by; no number leads to an address that a base of the rows, or a reserved one (by and ``anchor``), takes.

    The n-th homonym gets the n-th free number: the taken numbers of each base
    are the natural addresses base-k. Each of them has so many free numbers
    below it, so one sort of homonyms and taken numbers together says how many
    of these a homonym has to pass; there are no rounds, and no row carries a
    base's numbers.
    """
    w = Window.partitionBy(*by, "_base")
    d = rows.withColumn("_base", base).withColumn("_nth", F.row_number().over(w.orderBy(*order)))
    natural = d.select(*by, F.col("_base").alias("anchor"))
    first = F.lit(0)
    if reserved is not None:
        natural = natural.unionByName(reserved.select(*by, "anchor"))
        own = reserved.select(*by, F.col("anchor").alias("_base")).distinct().withColumn("_first", F.lit(1))
        d, first = d.join(own, [*by, "_base"], "left"), F.coalesce("_first", F.lit(0))
    # the first homonym has the base itself, unless that is reserved; _at: how many free numbers come before
    d = d.withColumns({"_at": F.col("_nth") + first - 2, "_row": F.lit(1)}).select(*rows.columns, "_base", "_at", "_row")
    taken = natural.distinct().withColumns({"_base": F.regexp_extract("anchor", r"^(.*)-(\d+)$", 1), "_k": F.regexp_extract("anchor", r"-(\d+)$", 1).try_cast("int")})
    taken = taken.where("_k is not null and _k >= 2 and anchor = concat(_base, '-', _k)")
    taken = taken.select(*by, "_base", (F.col("_k") - 1 - F.row_number().over(w.orderBy("_k"))).alias("_at"), F.lit(0).alias("_row"))
    passed = F.sum(1 - F.col("_row")).over(w.orderBy("_at", "_row").rowsBetween(Window.unboundedPreceding, 0))
    both = d.unionByName(taken, allowMissingColumns=True).withColumn("_k", F.col("_at") + 2 + passed).where("_row = 1")
    anchor = F.when((F.col("_at") < 0) | F.col("_base").isNull(), F.col("_base")).otherwise(F.concat_ws("-", "_base", "_k"))
    return both.withColumn("anchor", anchor).drop("_base", "_at", "_row", "_k")


def faults(anchors: DataFrame, by: list[str]) -> DataFrame:
    """Addresses that occur more than once, or that a URL would have to encode."""
    plain = F.col("anchor").rlike("^[A-Za-z0-9._~-]+$")
    return anchors.groupBy(*by, "anchor").agg(F.count("*").alias("n")).where((F.col("n") > 1) | ~plain).withColumn("fault", F.when(F.col("n") > 1, "repeated").otherwise("encoded"))


def kin(old: DataFrame, present: DataFrame) -> DataFrame:
    """old (``anchor``) with the present address (``id``, ``pos``) that it leads to and the rule that found it: 1 the same; 2 one that goes on with a member that is no number; 3 one that is the same but for a number at the end; 4 the longest whose extension the old one is. The first in the order of pos counts. Equi-joins only: on the address, on each of its beginnings, and on the address without its number."""
    base = lambda c: F.regexp_replace(c, r"-\d+$", "")
    begins = lambda c: F.transform(F.filter(F.sequence(F.lit(1), F.length(c)), lambda i: F.substring(c, i, F.lit(1)) == "-"), lambda i: F.substring(c, F.lit(1), i - 1))
    o = old.select("anchor").distinct()
    ids = present.groupBy("id").agg(F.min("pos").alias("pos"))
    one = o.join(ids, F.col("anchor") == F.col("id")).select("anchor", "id", "pos", F.lit(1).alias("rule"), F.lit(0).alias("w"))
    longer = ids.select("*", F.explode(begins(F.col("id"))).alias("b"))
    two = o.join(longer, F.col("anchor") == F.col("b")).where(~F.substring("id", F.length("anchor") + 2, F.lit(1 << 30)).rlike(r"^\d+$")).select("anchor", "id", "pos", F.lit(2).alias("rule"), F.lit(0).alias("w"))
    three = o.withColumn("b", base(F.col("anchor"))).join(ids.withColumn("b", base(F.col("id"))), "b").select("anchor", "id", "pos", F.lit(3).alias("rule"), F.lit(0).alias("w"))
    four = o.select("anchor", F.explode(begins(F.col("anchor"))).alias("b")).join(ids, F.col("b") == F.col("id")).select("anchor", "id", "pos", F.lit(4).alias("rule"), (-F.length("id")).alias("w"))
    best = one.union(two).union(three).union(four).groupBy("anchor").agg(F.min(F.struct("rule", "w", "pos", "id")).alias("m"))
    return o.join(best, "anchor", "left").select("anchor", F.col("m.id").alias("id"), F.col("m.rule").cast("long").alias("rule"))
