"""Blocks, ranks, and the section in force."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip, u

#: A block that opens with a number, a full stop and a dash opens that section.
OPENER = u(r"^(\d{1,3})\.\s*[—–]\s")


def blocks(docs: DataFrame, separator: str = "\n\n", doc: str = "doc_id", text: str = "text", more: list[str] = []) -> DataFrame:  # noqa: B006
    """(doc, rank, text, more columns of the document): the stripped parts between separators (a literal regular expression); empty ones take no rank. Ranks are counted in the row, without a shuffle."""
    parts = F.filter(F.transform(F.split(F.col(text), separator), strip), lambda b: b != "")
    return docs.select(doc, *more, F.posexplode(parts).alias("rank", "text")).select(doc, "rank", "text", *more).withColumn("rank", (F.col("rank") + 1).cast("long"))


def opener(text: Column) -> Column:
    return F.regexp_extract(text, OPENER, 1).try_cast("int")


def in_force(rows: DataFrame, value: Column, by: list[str], order: list, name: str = "section") -> DataFrame:
    """rows with the last non-null value at or before each, within by; null before the first."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.last(value, True).over(w))


def carried(rows: DataFrame, value: Column, by: list[str], order: str, name: str, stretch: int = 4096) -> DataFrame:
    """As in_force, for groups of any length: within stretches of order (a whole number), and from stretch to stretch by one value each, so that no task sees all rows of a group."""
    d = rows.withColumns({"_v": value, "_c": F.floor(F.col(order) / stretch)})
    inside = Window.partitionBy(*by, "_c").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    ends = d.groupBy(*by, "_c").agg(F.max(F.when(F.col("_v").isNotNull(), F.struct(order, "_v")))["_v"].alias("_end"))
    before = F.last("_end", True).over(Window.partitionBy(*by).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("_in", F.last("_v", True).over(inside)).join(ends.select(*by, "_c", before.alias("_before")), [*by, "_c"])
    return d.select(*rows.columns, F.coalesce("_in", "_before").alias(name))


def next_in_force(rows: DataFrame, value: Column, by: list[str], order: list, name: str) -> DataFrame:
    """rows with the first non-null value at or after each, within by."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    return rows.withColumn(name, F.first(value, True).over(w))


def changed(rows: DataFrame, value: Column, by: list[str], order: list) -> DataFrame:
    """The rows whose value differs from the one before, or has none before."""
    before = F.lag(value).over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn("_before", before).where(~F.col("_before").eqNullSafe(value)).drop("_before")


def sections(blocks: DataFrame, doc: str = "doc_id") -> DataFrame:
    return in_force(blocks, opener(F.col("text")), [doc], ["rank"])


def numbering(rows: DataFrame, number: Column, size: Column, by: list[str]) -> DataFrame:
    """For each group: distinct numbers, least, greatest, how many between are absent, rows without a number and their total size. Nulls, not errors, without any number."""
    return rows.groupBy(*by).agg(
        F.count_distinct(number).alias("numbers"), F.min(number).cast("long").alias("lowest"), F.max(number).cast("long").alias("highest"),
        (F.max(number) - F.min(number) + 1 - F.count_distinct(number)).cast("long").alias("absent"), F.count_if(number.isNull()).alias("unnumbered"), F.coalesce(F.sum(F.when(number.isNull(), size)), F.lit(0)).cast("long").alias("unnumbered_size"),
    )


def gap_ranges(numbers: DataFrame, number: str = "number") -> DataFrame:
    """(from, to): the numbers that occur around each stretch of numbers, between the least and the greatest, that do not."""
    n = numbers.select(F.col(number).cast("long").alias(number)).where(F.col(number).isNotNull()).distinct()
    after = F.lead(number).over(Window.partitionBy(F.floor(F.col(number) / 65536)).orderBy(number))
    # neighbours within stretches of 65536 numbers, then between stretches: no window over all
    inner = n.withColumn("to", after).where(F.col("to") > F.col(number) + 1).select(F.col(number).alias("from"), "to")
    ends = n.groupBy(F.floor(F.col(number) / 65536).alias("s")).agg(F.min(number).alias("lo"), F.max(number).alias("hi"))
    outer = ends.withColumn("to", F.lead("lo").over(Window.orderBy("s"))).where(F.col("to") > F.col("hi") + 1).select(F.col("hi").alias("from"), "to")
    return inner.union(outer)


def gaps(numbers: DataFrame, number: str = "number") -> DataFrame:
    """The numbers between the least and the greatest that do not occur. A gap of any width is taken apart in steps, so that no array has more than 65,536 entries."""
    d = gap_ranges(numbers, number).select((F.col("from") + 1).alias("_a"), (F.col("to") - 1).alias("_z"))
    for step in (1 << 48, 1 << 32, 1 << 16):
        parts = F.explode(F.sequence(F.col("_a"), F.col("_z"), F.lit(step).cast("long")))
        d = d.select(parts.alias("_a"), "_z").withColumn("_z", F.least("_z", F.col("_a") + (step - 1)))
    return d.select(F.explode(F.sequence("_a", "_z")).alias(number))


def duplicate_openers(numbers: DataFrame, keys: list[str]) -> DataFrame:
    return numbers.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def reunited(lines: DataFrame, ends: Column, by: list[str], order: str) -> DataFrame:
    """Lines joined by a space up to one that ends a paragraph (also the last): (by, paragraph, n_lines, text)."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    p = lines.withColumn("paragraph", F.coalesce(F.sum(ends.cast("long")).over(w), F.lit(0)) + 1)
    parts = F.array_sort(F.collect_list(F.struct(order, "text")))
    return p.groupBy(*by, "paragraph").agg(F.count("*").alias("n_lines"), F.array_join(parts["text"], " ").alias("text"))


def moved(blocks: DataFrame, chosen: Column, after: Column, by: list[str], order: str = "rank") -> DataFrame:
    """Blocks with the chosen ones taken out and set behind the last block that ``after`` holds for, in their order; new ranks. Without such a block nothing moves."""
    w = Window.partitionBy(*by)
    target = F.max(F.when(after & ~chosen, F.col(order))).over(w)
    key = F.when(chosen & target.isNotNull(), target).otherwise(F.col(order))
    d = blocks.withColumns({"_k": key, "_m": (chosen & target.isNotNull()).cast("int")})
    return d.withColumn("new_rank", F.row_number().over(w.orderBy("_k", "_m", order)).cast("long")).drop("_k", "_m")
