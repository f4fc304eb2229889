"""Notes and the places that call them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def outside_tags(fragment: Column, call: Column) -> Column:
    """Whether call occurs in fragment outside any tag."""
    return F.contains(F.regexp_replace(fragment, "<[^>]*>", "\u0001"), call)


def resolved(notes: DataFrame, fragments: DataFrame, leaf: str = "leaf") -> DataFrame:
    """notes (leaf, num, call) with ``block`` and ``how``: 1 the first fragment (leaf, pos, text) of the leaf that holds the call; 2 else another note of the leaf placed so whose text holds it; 3 else the last fragment that names the note in words; 4 else the leaf's last fragment, an orphan. Equi-joins on the leaf; the predicate and the rank decide within it."""
    pairs = notes.join(fragments, leaf)
    first = pairs.where(outside_tags(F.col("text"), F.col("call"))).groupBy(leaf, "num").agg(F.min("pos").alias("_one"))
    d = notes.join(first, [leaf, "num"], "left")
    placed = d.where("_one is not null").select(leaf, F.col("num").alias("_other"), F.col("call").alias("_text"), F.col("_one").alias("_at"))
    second = d.where("_one is null").join(placed, leaf).where(outside_tags(F.col("_text"), F.col("call"))).groupBy(leaf, "num").agg(F.min(F.struct("_at", "_other"))["_at"].alias("_two"))
    named = pairs.where(F.array_contains(F.regexp_extract_all("text", F.lit(r"(?i)\bnot[eo]\s*(\d+)"), 1), F.col("num").cast("string"))).groupBy(leaf, "num").agg(F.max("pos").alias("_three"))
    last = fragments.groupBy(leaf).agg(F.max("pos").alias("_four"))
    d = d.join(second, [leaf, "num"], "left").join(named, [leaf, "num"], "left").join(last, leaf, "left")
    how = F.when(F.col("_one").isNotNull(), 1).when(F.col("_two").isNotNull(), 2).when(F.col("_three").isNotNull(), 3).otherwise(4)
    return d.withColumn("block", F.coalesce("_one", "_two", "_three", "_four")).withColumn("how", how.cast("long")).drop("_one", "_two", "_three", "_four")


def continued(paragraphs: DataFrame, mark: Column, order: list[str]) -> DataFrame:
    """Paragraphs of a note block with the note they belong to: their own mark, or the last one before. The first column of order is the document."""
    return paragraphs.withColumn("note", F.last(mark, True).over(Window.partitionBy(order[0]).orderBy(*order[1:]).rowsBetween(Window.unboundedPreceding, 0)))
