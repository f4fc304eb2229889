"""Line checks over files as they arrive. Blocks and line openings need no state, so the batch functions serve as they are; counts are kept by Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit, corpus


def documents(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def opening_findings(docs: DataFrame) -> DataFrame:
    lines = corpus.blocks(docs, "\n")
    return audit.starts(lines, "space_before", audit.NO_START["space_before"]).unionByName(audit.starts(lines, "closing", audit.NO_START["closing"]))


def opening_counts(docs: DataFrame) -> DataFrame:
    return opening_findings(docs).groupBy("check").agg(F.count("*").alias("n"))
