"""Tables that cut a plan's lineage, in the folder that the driver and all executors see."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir. Where that is unset, one machine uses a folder of the warehouse, a cluster raises an error."""
    base = spark.conf.get("spark.checkpoint.dir", "")
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors see")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
