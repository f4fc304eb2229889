"""A table of computed rows that follows its source: only what has changed is computed and written again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import tables

#: Partitions of a cache: keys are dealt by their remainder.
PARTS = 64


def read(spark: SparkSession, path: str) -> DataFrame:
    """The computed rows that are in force."""
    return spark.read.parquet(path).where("_live").drop("_live", "_source", "_part")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(p)


def refresh(source: DataFrame, key: str, compute: Callable[[DataFrame], DataFrame], path: str, parts: int = PARTS) -> DataFrame:
    """Bring the cache at path up to date with source; one row: computed, kept, removed, and partitions rewritten.

    key: a whole number, each once. compute makes one row of each source row, key
    among its columns. Every row is kept with a hash of its source; rows whose
    hash is new or another are computed, the others of the same partition are
    copied, and Spark's dynamic overwrite replaces these partitions alone. Rows
    of keys that are gone are marked, so that a partition never has to vanish.
    The new partitions are a table of their own before the cache changes: a
    failure before that leaves it as it was.
    """
    spark = source.sparkSession
    part = F.pmod(F.col(key), F.lit(parts)).cast("int")
    now = source.select(F.col(key), F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(source.columns)]), {"ignoreNullFields": "false"}).cast("binary"), 256).alias("_source"))
    first = not _exists(spark, path)
    if first:
        stale = now.select(key, "_source")
        fresh = None
    else:
        old = spark.read.parquet(path)
        stale = now.join(old.where("_live").select(key, "_source"), [key, "_source"], "left_anti")
        gone = old.where("_live").join(now, key, "left_anti").select(key)
        stale, gone = (tables.written(x, tables.folder(spark, "stale")) for x in (stale, gone))
        hit = stale.select(part.alias("_part")).union(gone.select(part.alias("_part"))).distinct()  # parts rows at most
        fresh = old.join(F.broadcast(hit), "_part").join(stale.select(key), key, "left_anti")
        fresh = fresh.join(gone.withColumn("_gone", F.lit(True)), key, "left").withColumn("_live", F.col("_live") & F.col("_gone").isNull()).drop("_gone")
    made = compute(source.join(stale.select(key), key, "left_semi")).join(stale, key)
    made = made.withColumns({"_live": F.lit(True), "_part": part})
    if fresh is not None:
        made = made.unionByName(fresh.select(*made.columns))
    made = tables.written(made, tables.folder(spark, "cache"))
    made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_part").parquet(path)
    rewritten = made.agg(F.count_distinct("_part").alias("rewritten"))
    computed = stale.agg(F.count("*").alias("computed"))
    removed = spark.range(1).select(F.lit(0).cast("long").alias("removed")) if first else gone.agg(F.count("*").alias("removed"))
    kept = now.agg(F.count("*").alias("_all"))
    return computed.crossJoin(removed).crossJoin(rewritten).crossJoin(kept).select("computed", (F.col("_all") - F.col("computed")).alias("kept"), "removed", "rewritten")  # one row each
