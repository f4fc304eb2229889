"""Joins that hold where a few keys have a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys that count as frequent: so many rows of the looked-up table are broadcast at most.
FREQUENT = 1024


def looked_up(rows: DataFrame, table: DataFrame, keys: list[str], counts: DataFrame | None = None, most: int = FREQUENT) -> DataFrame:
    """rows with the other columns of table (one row for each key), null where it has none: a left join in two parts.

    The most frequent keys of the rows, ``most`` of them whatever the size of
    the tables, are looked up in a map that goes with the tasks and are never
    dealt out; all other rows meet table by key, and none of those keys has more
    than a share of 1 / most of the rows. A null key finds nothing and is not
    dealt out either. counts (keys, n) says how frequent keys are, if that is
    known already. rows are read twice, so what is costly to make is best written
    before.
    """
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n")) if counts is None else counts
    more = [c for c in table.columns if c not in keys]
    no_null = [F.col(k).isNotNull() for k in keys]
    whole = no_null[0]
    for c in no_null[1:]:
        whole = whole & c
    hot = counts.where(whole).orderBy(F.desc("n"), *keys).limit(most).select(*keys).join(table, keys, "left").withColumn("_hot", F.lit(True))
    marked = rows.join(F.broadcast(hot), keys, "left")  # most rows at most
    out = [*rows.columns, *more]
    found = marked.where(F.col("_hot").isNotNull() | ~whole).select(*out)  # a null key meets nothing in the map either
    rest = marked.where(F.col("_hot").isNull() & whole).select(*rows.columns).join(table, keys, "left").select(*out)
    return found.unionByName(rest)
