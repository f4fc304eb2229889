"""Statistics of measured lines: medians by index and by interpolation, modes, deviations, windows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import joins, layout, tables


#: Ranges that values are counted in, values of one range that are looked at together, and chosen ranges that are broadcast at most.
RANGES, SMALL, BROADCAST = 4096, 4096, 10_000


def _range(v: Column, low: Column, high: Column) -> Column:
    """The number of the range that v is in, of RANGES from low to high; it never falls where v rises. NaN, which sorts behind all numbers, has one of its own."""
    x, lo, hi = (c.cast("double") for c in (v, low, high))
    inner = F.floor(F.nanvl((x - lo) / (hi - lo), F.lit(0.5)) * RANGES)
    return F.when(F.isnan(x), RANGES).when(x <= lo, 0).when(x >= hi, RANGES - 1).otherwise(F.greatest(F.least(inner, F.lit(RANGES - 1)), F.lit(0))).cast("int")


def picked(rows: DataFrame, value: str, by: list[str], ranks: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """(by, names of ranks, _n): for each name the value at that rank, from 0, of the group's sorted values; a rank is given by the number of values. Rows with a null value or by are left out.

    Values are counted in ranges, a row for each group, range and task; the range
    that holds a rank is known from the counts. If all its values are equal
    that is the answer; if they are few they are looked at, else the range
    is cut into ranges again. So no task sees a group's values, only the counts
    of RANGES ranges or SMALL values.
    """
    spark, folder = rows.sparkSession, tables.folder(rows.sparkSession, "picked")
    whole = F.col(value).isNotNull()
    for b in by:
        whole = whole & F.col(b).isNotNull()
    d = rows.where(whole).select(*by, F.col(value).alias("_v"))
    real = F.when(~F.isnan(F.col("_v").cast("double")), F.col("_v"))
    ends = d.agg(F.min(real).alias("a"), F.max(real).alias("z")).first()
    kind = d.schema["_v"].dataType
    d = d.withColumns({"_path": F.lit(""), "_a": F.lit(ends["a"]).cast(kind), "_z": F.lit(ends["z"]).cast(kind)})
    asked, found, turn = None, [], 0
    while True:
        d = d.withColumn("_r", _range(F.col("_v"), F.col("_a"), F.col("_z")))
        h = d.groupBy(*by, "_path", "_r").agg(F.count("*").alias("_k"), F.min("_v").alias("_a"), F.max("_v").alias("_z"))
        w = Window.partitionBy(*by, "_path")
        h = h.withColumns({"_upto": F.sum("_k").over(w.orderBy("_r").rowsBetween(Window.unboundedPreceding, 0)), "_n": F.sum("_k").over(w)})
        if asked is None:
            each = F.explode(F.array(*[F.struct(F.lit(k).alias("name"), f(F.col("_n")).cast("long").alias("rank")) for k, f in ranks.items()])).alias("_e")
            h = h.select("*", each).select("*", "_e.*").withColumn("_all", F.col("_n"))
        else:
            h = h.join(asked, [*by, "_path"])
        got = h.where((F.col("rank") < F.col("_upto")) & (F.col("rank") >= F.col("_upto") - F.col("_k")))
        got = got.select(*by, "_path", "_r", "_k", "_a", "_z", "name", (F.col("rank") - F.col("_upto") + F.col("_k")).alias("rank"), "_all")
        got = tables.written(got, f"{folder}/{turn}")
        found.append(got.where(F.col("_a") == F.col("_z")).select(*by, "name", F.col("_a").alias("_v"), "_all"))
        n, large = got.where("_a < _z").agg(F.count("*"), F.count_if(F.col("_k") > SMALL)).first()
        own = got.where("_a < _z")
        among = lambda some: F.broadcast(some) if n <= BROADCAST else some  # noqa: B023, E731  n rows at most
        chosen = own.select(*by, "_path", "_r", F.col("_a").alias("_lo"), F.col("_z").alias("_hi"), "_k").distinct()
        if n > large:
            few = d.join(among(chosen.where(F.col("_k") <= SMALL)), [*by, "_path", "_r"]).groupBy(*by, "_path", "_r").agg(F.sort_array(F.collect_list("_v")).alias("_vs"))
            at = F.element_at("_vs", (F.col("rank") + 1).cast("int")).alias("_v")
            found.append(own.where(F.col("_k") <= SMALL).join(few, [*by, "_path", "_r"]).select(*by, "name", at, "_all"))
        if not large:
            break
        path = F.concat_ws("/", "_path", "_r").alias("_path")
        rest = d.join(among(chosen.where(F.col("_k") > SMALL)), [*by, "_path", "_r"])
        d = tables.written(rest.select(*by, "_v", path, F.col("_lo").alias("_a"), F.col("_hi").alias("_z")), f"{folder}/rest{turn}")
        asked = own.where(F.col("_k") > SMALL).select(*by, path, "name", "rank", "_all")
        turn += 1
    every = reduce(DataFrame.unionByName, found)
    return every.groupBy(*by).agg(*[F.max(F.when(F.col("name") == k, F.col("_v"))).alias(k) for k in ranks], F.max("_all").alias("_n"))


def by_index(rows: DataFrame, value: str, by: list[str], picks: dict[str, tuple[int, int]]) -> DataFrame:
    """(by, picks): for each name the element at index n * numerator // denominator of the group's sorted values; not interpolated."""
    at = {k: lambda n, num=num, den=den: F.floor(n * num / den) for k, (num, den) in picks.items()}
    return picked(rows, value, by, at).drop("_n")


def quantiles(rows: DataFrame, value: str, by: list[str], picks: dict[str, float]) -> DataFrame:
    """(by, picks, _n): for each name the quantile at that share, interpolated between neighbours."""
    ranks = {f"{end}_{k}": lambda n, f=f, share=share: f((n - 1) * share) for k, share in picks.items() for end, f in (("lo", F.floor), ("hi", F.ceil))}
    part = lambda share: (F.col("_n") - 1) * share - F.floor((F.col("_n") - 1) * share)
    d = picked(rows, value, by, ranks)
    return d.select(*by, *[(F.col(f"lo_{k}") * (1 - part(share)) + F.col(f"hi_{k}") * part(share)).alias(k) for k, share in picks.items()], "_n")


def mode_centroid(rows: DataFrame, value: str, by: list[str], reach: int = 2) -> DataFrame:
    """(by, mode, centroid): the most frequent whole value (the lowest of equals), and the mean of the values within reach of it."""
    h = rows.groupBy(*by, F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    m = h.groupBy(*by).agg(F.min(F.struct((-F.col("_n")).alias("n"), "_v"))["_v"].alias("mode"))
    near = h.join(m, by).where(F.abs(F.col("_v") - F.col("mode")) <= reach)
    return near.groupBy(*by, "mode").agg(F.round(F.sum(F.col("_v") * F.col("_n")) / F.sum("_n"), 6).alias("centroid"))


def deviations(rows: DataFrame, value: str, width: str, by: list[str], group: list[str], least: int = 4, share: float = 0.45, limit: float = 0.12) -> DataFrame:
    """rows with ``verdict``: null for what is not judged (a group of fewer than least rows, or a row not wider than share of the widest of its by), else whether value is more than limit of the group's median away from it."""
    page = Window.partitionBy(*by)
    wide = rows.withColumn("_wide", F.col(width) > F.max(width).over(page) * share)
    g = quantiles(wide.where("_wide"), value, group, {"middle": 0.5})
    d = wide.join(g, group, "left")
    ok = F.col("_wide") & (F.col("_n") >= least)
    return d.withColumn("verdict", F.when(ok, F.abs(F.col(value) / F.col("middle") - 1) > limit)).drop("_wide", "_n")


def rolling_median(rows: DataFrame, value: str, by: list[str], order: list[str], reach: int = 1) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(-reach, reach)
    xs = F.array_sort(F.collect_list(value).over(w))
    n = F.size(xs)
    mid = (F.element_at(xs, F.floor((n + 1) / 2).cast("int")) + F.element_at(xs, F.floor(n / 2 + 1).cast("int"))) / 2
    return rows.withColumn("rolled", mid)


def pitch(rows: DataFrame, y: Column, by: list[str], order: list[str]) -> DataFrame:
    return rows.withColumn("pitch", y - F.lag(y).over(Window.partitionBy(*by).orderBy(*order)))


def densest(rows: DataFrame, value: str, by: list[str], order: list[str], size: int) -> DataFrame:
    """(by, total, densest): the sum, and the largest sum of size successive rows that start with fewer than size rows short of the end."""
    w = Window.partitionBy(*by).orderBy(*order)
    d = rows.withColumns({"_s": F.sum(value).over(w.rowsBetween(0, size - 1)), "_i": F.row_number().over(w), "_n": F.count("*").over(Window.partitionBy(*by))})
    return d.groupBy(*by).agg(F.sum(value).alias("total"), F.max(F.when(F.col("_i") <= F.col("_n") - size, F.col("_s"))).alias("densest"))


def drift(rows: DataFrame, value: str, by: list[str], order: list[str], limit: float) -> DataFrame:
    """(by, worst, drifts): the largest distance from the group's median of the rolling median of three."""
    m = rows.withColumn("_r", F.col(value) - F.median(value).over(Window.partitionBy(*by)))
    r = rolling_median(m, "_r", by, order)
    return r.groupBy(*by).agg(F.max(F.abs("rolled")).alias("worst")).withColumn("drifts", F.col("worst") > limit)


def margins(rows: DataFrame, left: Column, right: Column, page: str) -> DataFrame:
    """(page, margin), the smaller side's least on each page."""
    return rows.groupBy(page).agg(F.min(F.least(left, right)).alias("margin"))


def best_offset(a: DataFrame, b: DataFrame, by: list[str], reach: int = 10) -> DataFrame:
    """(by, offset, votes): the whole offset that brings most values y of a within reach of some value of b; the smallest of equals.

    What is within reach of b's values is a set of bands. Each value of a votes
    for the offsets from a band's begin to its end, less itself: one more vote
    from there on, one less behind it, and the votes of an offset are a running
    sum. Pairs of values and bands are made within by only, which is a page.
    """
    bands = layout.merged(b.select(*by, (F.col("y") - reach).alias("start"), (F.col("y") + reach).alias("end")), 0, by).select(*by, "start", "end")
    ends = F.array(F.struct((F.col("start") - F.col("y")).alias("offset"), F.lit(1).alias("d")), F.struct((F.col("end") - F.col("y") + 1).alias("offset"), F.lit(-1).alias("d")))
    moves = a.select(*by, "y").distinct().join(bands, by).select(*by, F.explode(ends).alias("_e")).select(*by, "_e.*").groupBy(*by, "offset").agg(F.sum("d").alias("d"))
    votes = moves.withColumn("votes", F.sum("d").over(Window.partitionBy(*by).orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)))
    return votes.groupBy(*by).agg(F.min(F.struct((-F.col("votes")).alias("v"), F.col("offset"))).alias("m")).select(*by, F.col("m.offset").alias("offset"), (-F.col("m.v")).alias("votes"))


def circular_mean(rows: DataFrame, degrees: Column, by: list[str], harmonic: int = 1) -> DataFrame:
    """(by, mean, concentration, n) of angles that count modulo 360 / harmonic degrees: the angle of the mean of their points on the circle, from 0 on, and the length of that mean, 1 where all agree. Sums of sines and cosines are all that moves; null angles do not count."""
    turned = F.radians(degrees * harmonic)
    d = rows.groupBy(*by).agg(F.sum(F.cos(turned)).alias("_x"), F.sum(F.sin(turned)).alias("_y"), F.count(degrees).alias("n"))
    mean = F.pmod(F.degrees(F.atan2("_y", "_x")) / harmonic, F.lit(360.0 / harmonic))
    return d.select(*by, F.when(F.col("n") > 0, mean).alias("mean"), (F.sqrt(F.col("_x") * F.col("_x") + F.col("_y") * F.col("_y")) / F.nullif("n", F.lit(0))).alias("concentration"), "n")


def apart(rows: DataFrame, degrees: str, value: str, by: list[str], most: int = 6, least: float = 25.0) -> DataFrame:
    """(by, nth, degrees, value): the greatest value of each group, then the greatest of those more than least degrees from all that were taken, and so on, most of them; ties go to the smaller angle.

    Each turn is one aggregation with partial results, so no group is gathered;
    what a group has taken, most angles at most, goes to its rows by a look-up
    that frequent groups do not skew.
    """
    spark = rows.sparkSession
    folder = tables.folder(spark, "apart")
    d = rows.select(*by, F.col(degrees).cast("double").alias("_a"), F.col(value).alias("_v")).where("_a is not null and _v is not null")
    counts = tables.written(d.groupBy(*by).agg(F.count("*").alias("n")), f"{folder}/counts")
    taken = None
    for nth in range(1, most + 1):
        left = d
        if taken is not None:
            own = taken.groupBy(*by).agg(F.collect_list("_a").alias("_taken"))  # most at most
            near = lambda p: F.least(F.pmod(F.abs(F.col("_a") - p), F.lit(360.0)), 360.0 - F.pmod(F.abs(F.col("_a") - p), F.lit(360.0))) <= least
            left = joins.looked_up(d, own, by, counts).where(~F.coalesce(F.exists("_taken", near), F.lit(False)))
        best = left.groupBy(*by).agg(F.max(F.struct("_v", (-F.col("_a")).alias("_b"))).alias("_m"))
        best = tables.written(best.select(*by, F.lit(nth).alias("nth"), (-F.col("_m._b")).alias("_a"), F.col("_m._v").alias("_v")), f"{folder}/{nth}")
        if best.isEmpty():
            break
        taken = best if taken is None else taken.unionByName(best)
    taken = d.select(*by, F.lit(0).alias("nth"), "_a", "_v").where("false") if taken is None else taken
    return taken.select(*by, "nth", F.col("_a").alias(degrees), F.col("_v").alias(value))


def local_pitch(rows: DataFrame, pitch: str, by: list[str], side: str, least: int = 4) -> DataFrame:
    """rows with ``usual``: the median pitch of their own side (text or notes) of the page, or of the whole page where that side has fewer than least."""
    own, page = Window.partitionBy(*by, side), Window.partitionBy(*by)
    return rows.withColumn("usual", F.when(F.count(pitch).over(own) >= least, F.median(pitch).over(own)).otherwise(F.median(pitch).over(page)))


def excess(rows: DataFrame, pitch: str, by: list[str], limit: float) -> DataFrame:
    """Rows whose pitch is more than limit over the page's median, with by how much."""
    d = rows.withColumn("excess", F.col(pitch) - F.median(pitch).over(Window.partitionBy(*by)))
    return d.where(F.col("excess") > limit)


def line_starts(x: Column, margin: float, indent: float, centre: Column, slack: float) -> Column:
    """Where a line starts: at the margin, at the indent, centred, or odd; null if not measured."""
    near = lambda y: F.abs(x - y) <= slack
    return F.when(near(F.lit(margin)), "margin").when(near(F.lit(indent)), "indent").when(F.abs(centre) <= slack, "centred").when(x.isNotNull(), "odd")


def three_valued(rows: DataFrame, by: list[str], found: Column, wanted: Column) -> DataFrame:
    """(by, verdict): ok or wrong where both numbers are there, else not judged, which is not ok."""
    v = F.when(found.isNull() | wanted.isNull(), "not judged").when(found == wanted, "ok").otherwise("wrong")
    return rows.select(*by, v.alias("verdict"))


def line_ends(share: Column, full: Column, least: float = 0.94, most: float = 0.995) -> Column:
    """How a line ends, share being its end over the page's right margin: a line that has to be full (``full``) is short below least, another one runs to the margin beyond most; null if not measured."""
    return F.when(full & (share < least), "short").when(~full & (share > most), "to the margin").when(share.isNotNull(), "ok")


def suspects(rows: DataFrame, pitch: str, usual: str, ratio: float = 1.5, white: float = -3.0, tolerance: float = 4.5) -> DataFrame:
    """The pitches that may hide a line: ratio times the usual one or more, unless a line missing there would leave less than white; ``exact`` where two usual pitches are it, within tolerance."""
    over = F.col(pitch) - 2 * F.col(usual)
    return rows.where((F.col(pitch) >= ratio * F.col(usual)) & (over >= white)).withColumn("exact", F.abs(over) <= tolerance)


def welded(rows: DataFrame, height: str, by: list[str], order: list[str], ratio: float = 1.7, least: int = 8) -> DataFrame:
    """Bands as high as two lines: ratio times the page's median height or more, but not a page's first; pages of fewer than least bands are not judged."""
    page = Window.partitionBy(*by)
    d = rows.withColumns({"middle": F.median(height).over(page), "_n": F.count("*").over(page), "_k": F.row_number().over(page.orderBy(*order))})
    return d.where((F.col("_n") >= least) & (F.col("_k") > 1) & (F.col("middle") > 0) & (F.col(height) >= ratio * F.col("middle"))).drop("_n", "_k")


def proposals(boundaries: DataFrame, excess: DataFrame, keys: list[str], ordinary: float, least: float = 3.0) -> DataFrame:
    """boundaries with ``space``, what to set there: the whole excess where it is more than the ordinary space by least, the (negative) difference where it is less by least; a boundary without excess has none, and one as usual is not proposed."""
    e = F.coalesce("excess", F.lit(0.0))
    d = boundaries.join(excess.select(*keys, "excess"), keys, "left").withColumn("excess", e).withColumn("_d", F.col("excess") - ordinary)
    return d.where(F.abs("_d") >= least).withColumn("space", F.when(F.col("_d") > 0, F.col("excess")).otherwise(F.col("_d"))).drop("_d")
