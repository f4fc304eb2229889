"""Topics over blocks, and search in a page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import snippet, u


def topic_hits(blocks: DataFrame, topics: dict[str, str]) -> DataFrame:
    """One row for each block and topic whose pattern it matches, letters of either case. Each rule is a literal pattern, compiled once; there is no join."""
    hit = F.array_compact(F.array(*[F.when(F.col("text").rlike(u(p, True)), F.lit(name)) for name, p in topics.items()]))
    return blocks.select("*", F.explode(hit).alias("topic"))


def topic_totals(docs: DataFrame, topics: dict[str, str], separator: str = "\n") -> DataFrame:
    """(topic, n_blocks, n_docs) of documents, a row each: blocks are counted inside the row, where the text has a hit at all, and a row of sums for each task is all that moves."""
    blocks = F.split("text", separator)

    def hits(pattern: str) -> Column:
        return F.when(F.col("text").rlike(pattern), F.size(F.filter(blocks, lambda b: b.rlike(pattern)))).otherwise(0)

    n = {k: hits(u(p, True)) for k, p in topics.items()}
    own = docs.select(*[c.alias(f"_{i}") for i, c in enumerate(n.values())])
    sums = own.agg(*[F.sum(f"_{i}").alias(f"a{i}") for i in range(len(n))], *[F.count_if(F.col(f"_{i}") > 0).alias(f"b{i}") for i in range(len(n))])
    each = F.array(*[F.struct(F.lit(k).alias("topic"), F.col(f"a{i}").alias("n_blocks"), F.col(f"b{i}").alias("n_docs")) for i, k in enumerate(n)])
    return sums.select(F.explode(each).alias("_t")).select("_t.*").where("n_blocks > 0")


def search(index: DataFrame, query: str, order: list[str], shown: int = 300, least: int = 2) -> DataFrame:
    """The first hit of query in each row, in order: hit (its number), at, total, snippet; the first ``shown`` only, a feature of the search. A shorter query than ``least`` finds nothing."""
    at = F.instr(F.lower("text"), query.lower())
    found = index.where(at > 0) if len(query) >= least else index.where(F.lit(False))
    total = found.agg(F.count("*").alias("total"), F.lit(1).alias("_one"))
    top = found.orderBy(*order).limit(shown).withColumn("hit", F.row_number().over(Window.orderBy(*order)).cast("long"))
    return top.withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one").select(*order, "hit", at.cast("long").alias("at"), "total", snippet(F.col("text"), at, F.lit(len(query))).alias("snippet"))  # total: one row


def page_pieces(hits: DataFrame, head: Column, by: list[str], doc: str, order: list[str], stretch: int = 4096) -> DataFrame:
    """(by, doc, order, piece): each block of a topic's page, with a heading before it where the heading differs from that of the block before; a blank line goes between pieces.

    No task sees a whole topic: neighbours meet within stretches of doc (a whole
    number), and of stretches only the first and the last block meet.
    """
    d = hits.withColumns({"_head": head, "_s": F.floor(F.col(doc) / stretch)})
    inside = Window.partitionBy(*by, "_s").orderBy(doc, *order)
    ends = d.groupBy(*by, "_s").agg(F.max(F.struct(doc, *order, "_head"))["_head"].alias("_last"))
    ends = ends.select(*by, "_s", F.lag("_last").over(Window.partitionBy(*by).orderBy("_s")).alias("_before"))
    d = d.withColumns({"_lag": F.lag("_head").over(inside), "_first": F.row_number().over(inside) == 1}).join(ends, [*by, "_s"])
    new = ~F.when(F.col("_first"), F.col("_before")).otherwise(F.col("_lag")).eqNullSafe(F.col("_head"))
    piece = F.concat(F.when(new, F.concat(F.lit("## "), F.col("_head"), F.lit("\n\n"))).otherwise(F.lit("")), F.col("text"))
    return d.select(*by, doc, *order, piece.alias("piece"))


def top_heads(lines: DataFrame, head: Column, by: list[str], order: list[str]) -> DataFrame:
    """Each line with the nearest head at or above it."""
    return lines.withColumn("head", F.last(head, True).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
