"""Writers: one file for each topic, entry or chapter, reports, and a gate before export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def partitioned(df: DataFrame, path: str, by: str, kind: str = "parquet") -> None:
    """df with one folder for each value of by; what was there before goes."""
    df.write.mode("overwrite").partitionBy(by).format(kind).save(path)


def paged(pieces: DataFrame, path: str, by: str, order: list[str]) -> None:
    """pieces as text, a folder for each value of by, each piece followed by a blank line; the files of a folder, one after the other, are in order."""
    d = pieces.repartitionByRange(by, *order).sortWithinPartitions(by, *order)
    d.select(by, F.concat("piece", F.lit("\n")).alias("value")).write.mode("overwrite").partitionBy(by).text(path)


def chapters(blocks: DataFrame, by: list[str], note: str = "is_note") -> DataFrame:
    """(by, n_blocks, size, text): a group's blocks in rank, apart by a blank line; every line of a note behind ``> ``."""
    piece = F.when(F.col(note), F.regexp_replace("text", "(?m)^", "> ")).otherwise(F.col("text"))
    text = F.array_join(F.array_sort(F.collect_list(F.struct("rank", piece.alias("t"))))["t"], "\n\n")
    return blocks.groupBy(*by).agg(F.count("*").alias("n_blocks"), text.alias("text")).withColumn("size", F.octet_length("text").cast("long"))


def sizes(files: DataFrame, by: list[str], text: str = "text") -> DataFrame:
    """(by, files, bytes, mean, largest, kib): kib is one at least."""
    n = F.octet_length(text).cast("long")
    d = files.groupBy(*by).agg(F.count("*").alias("files"), F.sum(n).alias("bytes"), F.round(F.avg(n), 6).alias("mean"), F.max(n).alias("largest"))
    return d.withColumn("kib", F.greatest(F.floor(F.col("bytes") / 1024), F.lit(1)).cast("long"))


def tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, sep="\t", header=True)


def gated(df: DataFrame, witnesses: DataFrame, path: str) -> bool:
    """Write df only if every witness is ok; say whether it was written."""
    if witnesses.where("status <> 'ok'").limit(1).count():
        return False
    df.write.mode("overwrite").parquet(path)
    return True
