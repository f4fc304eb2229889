"""Pages, parts and positions: as-of and nearest joins as windows, clusters and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import tables


def _both(by: list[str], at: str):
    w = Window.partitionBy(*by).orderBy(at)
    return w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)


def nearest(rows: DataFrame, points: DataFrame, by: list[str], at: str) -> DataFrame:
    """rows with ``near`` and ``value``, the place and value of the nearest point (by, at, value) before or after; ties go to the lower one. One sort of rows and points together, no join."""
    both = rows.withColumns({"_row": F.lit(True), "_p": F.lit(None).cast("struct<at:bigint,value:string>")}).unionByName(
        points.select(*by, at, F.lit(False).alias("_row"), F.struct(F.col(at).cast("long").alias("at"), F.col("value").cast("string").alias("value")).alias("_p")), allowMissingColumns=True
    )
    back, ahead = _both(by, at)
    d = both.withColumns({"_b": F.last("_p", True).over(back), "_a": F.first("_p", True).over(ahead)})
    # rows and points at one place may come in either order: both windows look from the place itself
    w = Window.partitionBy(*by, at)
    here = F.min("_p").over(w)
    d = d.withColumns({"_b": F.coalesce(here, "_b"), "_a": F.coalesce(here, "_a")}).where("_row")
    take_b = F.col("_a").isNull() | (F.col("_b").isNotNull() & (F.col(at) - F.col("_b.at") <= F.col("_a.at") - F.col(at)))
    p = F.when(take_b, F.col("_b")).otherwise(F.col("_a"))
    return d.withColumns({"near": p["at"], "value": p["value"]}).drop("_row", "_p", "_a", "_b")


def before(rows: DataFrame, starts: DataFrame, by: list[str], at: str) -> DataFrame:
    """rows with ``start`` and ``value`` of the last start (by, at, value) at or before; null before the first."""
    both = rows.withColumns({"_row": F.lit(1), "_p": F.lit(None).cast("struct<at:bigint,value:string>")}).unionByName(
        starts.select(*by, at, F.lit(0).alias("_row"), F.struct(F.col(at).cast("long").alias("at"), F.col("value").cast("string").alias("value")).alias("_p")), allowMissingColumns=True
    )
    w = Window.partitionBy(*by).orderBy(at, "_row", "_p").rowsBetween(Window.unboundedPreceding, 0)
    d = both.withColumn("_s", F.last("_p", True).over(w)).where("_row = 1")
    return d.withColumns({"start": F.col("_s.at"), "value": F.col("_s.value")}).drop("_row", "_p", "_s")


def closest(value: Column, landmarks: list[float]) -> Column:
    """The number (from 0) of the landmark nearest to value; ties go to the first."""
    marks = F.array(*[F.struct(F.abs(value - F.lit(float(x))).alias("d"), F.lit(i).cast("long").alias("i")) for i, x in enumerate(landmarks)])
    return F.when(value.isNotNull(), F.array_min(marks)["i"])


def clusters(rows: DataFrame, x: Column, gap, by: list[str], order: list) -> DataFrame:
    """rows with ``cluster``, counted from 1 within by: a new one where x is more than gap beyond the one before."""
    w = Window.partitionBy(*by).orderBy(*order)
    new = F.coalesce((x - F.lag(x).over(w) > gap).cast("long"), F.lit(0))
    return rows.withColumn("_new", new).withColumn("cluster", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)) + 1).drop("_new")


def runs(rows: DataFrame, on: Column, by: list[str], order: list[str]) -> DataFrame:
    """(by, start, end, n): stretches of rows in order for which ``on`` holds, with the first and last value of order."""
    w = Window.partitionBy(*by).orderBy(*order)
    d = rows.withColumn("_on", F.coalesce(on, F.lit(False))).withColumn("_i", F.row_number().over(w))
    d = d.withColumn("_turn", F.sum((~F.col("_on")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))).where("_on")
    return d.groupBy(*by, "_turn").agg(F.min(order[0]).alias("start"), F.max(order[0]).alias("end"), F.count("*").alias("n")).drop("_turn")


def merged(bands: DataFrame, gap, by: list[str]) -> DataFrame:
    """(by, start, end, n) of bands (start, end) joined where the next starts gap or less behind the furthest end so far."""
    w = Window.partitionBy(*by).orderBy("start", "end")
    far = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    d = bands.withColumn("_new", F.coalesce((F.col("start") - far > gap).cast("int"), F.lit(1)))
    d = d.withColumn("_g", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return d.groupBy(*by, "_g").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n")).drop("_g")


def parents(groups: DataFrame) -> DataFrame:
    """groups (id, title, rows: array) with the smallest other group whose rows contain the title; ties go to the lower id; null for roots."""
    inner = groups.select(F.col("id").alias("parent"), F.explode("rows").alias("title"), F.size("rows").alias("_size"))
    best = groups.select("id", "title").join(inner, "title").where("id <> parent").groupBy("id").agg(F.min(F.struct("_size", "parent"))["parent"].alias("parent"))
    return groups.join(best, "id", "left")


def subset(inner: Column, outer: Column) -> Column:
    return F.size(F.array_except(inner, outer)) == 0


def covered(groups: DataFrame, below: bool = False) -> DataFrame:
    """groups (id, parent, rows) with ``covered``: their rows and those of all groups above them or, with below, of all groups under them and of the titles, where there is that column.

    However deep the tree is: each round goes one level on and is written, until
    nothing is added. Groups in a circle cover each other.
    """
    folder = tables.folder(groups.sparkSession, "covered")
    schema = groups.select("id", F.col("id").alias("above")).schema

    up = groups.where("parent is not null").select(F.col("id").alias("_id"), F.col("parent").cast(schema["id"].dataType).alias("_up")).distinct()
    last = tables.written(up.select(F.col("_id").alias("id"), F.col("_up").alias("above")), f"{folder}/0")
    pairs, k = last, 0
    while not last.isEmpty():
        k += 1
        further = last.join(up, last["above"] == up["_id"]).select("id", F.col("_up").alias("above")).distinct()
        last = tables.written(further.join(pairs, ["id", "above"], "left_anti"), f"{folder}/{k}")
        pairs = pairs.unionByName(last)
    own = F.concat("rows", F.array("title")) if below and "title" in groups.columns else F.col("rows")
    rows = groups.select("id", F.explode(own).alias("_row")).where("_row is not null")
    to, of = ("above", "id") if below else ("id", "above")
    reached = pairs.select(F.col(to).alias("_to"), F.col(of).alias("_of")).join(rows, F.col("_of") == F.col("id")).select(F.col("_to").alias("id"), "_row")
    every = rows.unionByName(reached).groupBy("id").agg(F.collect_set("_row").alias("covered"))
    d = groups.join(every, "id", "left")
    return d.select(*[d[c] for c in groups.columns], F.coalesce("covered", F.slice("rows", 1, 0)).alias("covered"))


def span(height: Column, gap: Column, row: Column, total: Column, pitch: float) -> Column:
    """(first, rows) that a brace at a row spans: its height over the line pitch, half to even, one at least; its middle is gap above the row; it stays within the table's total rows."""
    n = F.greatest(F.bround(height / pitch).cast("int"), F.lit(1))
    first = F.bround(row - gap / pitch - (n - 1) / 2.0).cast("int")
    return F.struct(F.greatest(F.least(first, total - n), F.lit(0)).cast("int").alias("first"), n.alias("rows"))


def apparatus(rows: DataFrame, y: str, page: list[str], order: list[str], threshold: float = 60.0) -> DataFrame:
    """rows with ``part`` and ``nth``: what is laid above the threshold is read before the page's body (head), the rest behind it (foot), both from top to bottom; order breaks ties."""
    d = rows.withColumn("part", F.when(F.col(y) < threshold, "head").when(F.col(y).isNotNull(), "foot"))
    return d.where("part is not null").withColumn("nth", F.row_number().over(Window.partitionBy(*page, "part").orderBy(y, *order)).cast("long"))
