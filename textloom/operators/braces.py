"""What the braces of a table gather: leaders, groups of rows, their titles and the tree that they make."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import bracerows, layout, tables

#: Kinds of cells: a brace that opens to the right, one that points up to the row above, one that closes, and leader dots; an ordinary cell has none.
OPEN, UP, CLOSE, LEADER = "open", "up", "close", "leader"
BRACES = (OPEN, UP, CLOSE)
#: Cells of a table, with those left out, up to which it is read in one piece.
MOST = 1 << 13


def merged_leaders(cells: DataFrame) -> DataFrame:
    """cells (table, row, ord, x, kind, height, gap, text) with leader dots put together: a dot joins the dots before it, and two dots or more go to the cell before, with a space; behind a brace, and at a row's begin, they are a cell of kind leader."""
    w = Window.partitionBy("table", "row").orderBy("ord")
    dots = F.coalesce(F.col("kind").isNull() & F.col("text").rlike(r"^\.+$"), F.lit(False))
    upto = w.rowsBetween(Window.unboundedPreceding, 0)

    def together(d: DataFrame, begins: Column, sep: str) -> DataFrame:
        d = d.withColumn("_new", begins).withColumn("_part", F.sum(F.col("_new").cast("int")).over(upto))
        first = {c: F.min_by(c, "ord").alias(c) for c in ("x", "kind", "height", "gap")}
        text = F.array_join(F.sort_array(F.collect_list(F.struct("ord", "text")))["text"], sep)
        return d.groupBy("table", "row", "_part").agg(F.min("ord").alias("ord"), *first.values(), text.alias("text")).drop("_part")

    one = together(cells.withColumn("_dots", dots), ~((F.col("text") == ".") & F.coalesce(F.lag("_dots").over(w), F.lit(False)) & F.col("kind").isNull()), "")
    one = one.withColumn("kind", F.when(dots & (F.length("text") > 1), LEADER).otherwise(F.col("kind")))
    before = F.lag(F.struct(F.lit(True).alias("any"), "kind")).over(w)
    stays = F.coalesce(F.col("kind") != LEADER, F.lit(True)) | before["any"].isNull() | F.coalesce(before["kind"].isin(*BRACES), F.lit(False))
    return together(one, stays, " ")


def _key(*c: str) -> Column:
    return F.concat_ws(":", *c)


def groups(cells: DataFrame, pitch: float) -> DataFrame:
    """The groups of cells (see merged_leaders, done before): (table, id, kind, row, ord, x, first, n, title, title_row, title_cell, parent, closed_by, covered).

    A brace spans so many rows as its height has pitches, around its own. An
    opening one's title is the cell nearest to its left in these rows, leaders
    if there is nothing else; one that points up has the last cell of the row
    above. A group without a title is none. It lies in the smallest group
    further left whose rows hold its title. A closing brace has its title to
    the right; where the groups whose rows it encloses are one group, of just
    these rows, it closes that one, else it is a group around the outermost of
    them. Closing braces look at the opening ones only; what two enclose goes
    to the smaller. covered: a group's rows, its title's, and those of all
    groups below it. Everything is joined by table and row.
    """
    folder = tables.folder(cells.sparkSession, "braces")
    total = cells.groupBy("table").agg((F.max("row") + 1).cast("int").alias("_total"))
    b = cells.where(F.col("kind").isin(*BRACES)).join(total, "table")
    span = layout.span(F.col("height"), F.col("gap"), F.col("row").cast("int"), F.col("_total"), pitch)
    b = b.withColumn("_s", F.when(F.col("kind") == UP, F.struct(F.col("row").cast("int").alias("first"), F.lit(1).alias("rows"))).otherwise(span))
    b = b.select("table", _key("table", "row", "ord").alias("id"), "kind", "row", "ord", "x", F.col("_s.first").alias("first"), F.col("_s.rows").alias("n"))
    looked = F.when(F.col("kind") == UP, F.array(F.col("row").cast("int") - 1)).otherwise(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1))
    each = b.select("table", "id", "kind", "x", F.explode(looked).alias("_row"))
    c = cells.select("table", F.col("row").cast("int").alias("_row"), F.col("ord").alias("_ord"), F.col("x").alias("_x"), F.col("kind").alias("_kind"), F.col("text").alias("_text"))
    near = each.join(c, ["table", "_row"])
    plain = F.col("_kind").isNull()
    fits = F.when(F.col("kind") == OPEN, (F.col("_x") < F.col("x")) & (plain | (F.col("_kind") == LEADER))).when(F.col("kind") == UP, plain).otherwise((F.col("_x") > F.col("x")) & plain)
    # an ordinary cell before leaders, then the nearest, then the first in the order of rows; above a brace the last
    order = F.when(F.col("kind") == OPEN, F.struct(plain.cast("double").alias("a"), F.col("_x").cast("double").alias("b"), (-F.col("_row")).cast("double").alias("c"), (-F.col("_ord")).cast("double").alias("d")))
    order = order.when(F.col("kind") == UP, F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("b"), F.lit(0.0).alias("c"), F.col("_ord").cast("double").alias("d")))
    order = order.otherwise(F.struct(F.lit(0.0).alias("a"), (-F.col("_x")).cast("double").alias("b"), (-F.col("_row")).cast("double").alias("c"), (-F.col("_ord")).cast("double").alias("d")))
    titles = near.where(fits).groupBy("id").agg(F.max_by(F.struct(F.col("_text").alias("title"), F.col("_row").alias("title_row"), _key("_row", "_ord").alias("title_cell")), order).alias("_t"))
    g = tables.written(b.join(titles, "id").select("table", "id", "kind", "row", "ord", "x", "first", "n", "_t.*"), f"{folder}/titled")

    opening = g.where(F.col("kind") != CLOSE)
    rows = F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)
    over = opening.select("table", F.col("id").alias("_up"), F.col("x").alias("_x"), F.col("n").alias("_n"), F.col("row").alias("_r"), F.col("ord").alias("_o"), F.col("title_cell").alias("_cell"), F.explode(rows).alias("title_row"))
    best = opening.join(over, ["table", "title_row"]).where("_up <> id and _x < x and _cell <> title_cell").groupBy("id").agg(F.min(F.struct("_n", "_r", "_o", "_up"))["_up"].alias("parent"))
    opening = tables.written(opening.join(best, "id", "left").withColumn("rows", F.array_distinct(F.concat(rows, F.array("title_row")))), f"{folder}/nested")
    deep = layout.covered(opening.select("id", "parent", "rows"), True).select("id", "covered")
    opening = tables.written(opening.join(deep, "id"), f"{folder}/covering")

    closing = g.where(F.col("kind") == CLOSE).select("table", F.col("id").alias("_c"), F.col("first").alias("_a"), F.col("n").alias("_n"), F.col("row").alias("_r"), F.col("ord").alias("_o"), F.col("title").alias("_title"))
    inside = opening.join(closing, "table").where((F.array_min("covered") >= F.col("_a")) & (F.array_max("covered") < F.col("_a") + F.col("_n")))
    inside = inside.select("id", "parent", "row", "ord", "_c", "_n", "_r", "_o", "_title", F.size("covered").alias("_size"))
    up = inside.select(F.col("id").alias("parent"), "_c", F.lit(True).alias("_in"))
    roots = inside.join(up, ["parent", "_c"], "left").where("_in is null")
    roots = tables.written(roots, f"{folder}/roots")
    whole = roots.groupBy("_c").agg(F.count("*").alias("_k"), F.max("_size").alias("_most"), F.max("_n").alias("_n"), F.min(F.struct("row", "ord", "id", "parent")).alias("_first"), F.max("_title").alias("_title"))
    closes = whole.where("_k = 1 and _most = _n").select("_c", F.col("_first.id").alias("id"), "_title")
    closed = closes.groupBy("id").agg(F.min("_title").alias("closed_by"))
    taken = roots.join(closes.select("_c"), "_c", "left_anti").groupBy("id").agg(F.min(F.struct("_n", "_r", "_o", "_c"))["_c"].alias("_within"))
    opening = opening.join(closed, "id", "left").join(taken, "id", "left").withColumn("parent", F.coalesce("_within", "parent"))
    around = g.where(F.col("kind") == CLOSE).join(closes.select(F.col("_c").alias("id")), "id", "left_anti").join(whole.select(F.col("_c").alias("id"), F.col("_first.parent").alias("parent")), "id", "left")
    columns = ["table", "id", "kind", "row", "ord", "x", "first", "n", "title", "title_row", "title_cell", "parent", "closed_by"]
    every = opening.select(*columns).unionByName(around.withColumn("closed_by", F.lit(None).cast("string")).select(*columns))
    d = tables.written(every.withColumn("rows", F.array_distinct(F.concat(rows, F.array("title_row")))), f"{folder}/every")
    deep = layout.covered(d.select("id", "parent", "rows"), True).select("id", F.array_sort("covered").alias("covered"))
    return d.drop("rows").join(deep, "id").select(*columns, "covered")


def row_groups(rows: DataFrame, pitch: float, most: int = MOST) -> DataFrame:
    """The same groups, from rows (table, row, cells: array of struct x, kind, height, gap, text; one that is null is no cell) whose leader dots are not put together yet.

    Where the rows are dealt and sorted by table already, nothing is shuffled:
    tables of up to most cells are read in Arrow batches of whole tables. Those
    of larger ones are put aside, and go through merged_leaders and groups.
    """
    d = rows.where("table is not null").select("table", "row", "cells")
    d = d.withColumn("_n", F.sum(F.size("cells")).over(Window.partitionBy("table")))
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("table", "cells")}
    read = d.mapInArrow(bracerows.reader(pitch, most), f"table {kinds['table']}, {bracerows.TYPES}, large struct<row: int, cells: {kinds['cells']}>")
    read = tables.written(read.withColumn("is_large", F.col("large").isNotNull()), f"{tables.folder(rows.sparkSession, 'brace_rows')}/read")
    parent = F.when(F.col("parent_row").isNotNull(), _key("table", "parent_row", "parent_ord"))
    found = read.where("not is_large").select(
        "table", _key("table", "row", "ord").alias("id"), "kind", "row", "ord", "x", "first", "n", "title", "title_row", _key("title_row", "title_ord").alias("title_cell"), parent.alias("parent"), "closed_by", "covered"
    )
    large = read.where("is_large").select("table", "large.row", "large.cells")
    if large.isEmpty():
        return found
    cells = large.select("table", "row", F.posexplode(F.array_compact("cells")).alias("ord", "c")).select("table", "row", "ord", "c.*")
    return found.unionByName(groups(merged_leaders(cells), pitch))


def uncovered(cells: DataFrame, found: DataFrame) -> DataFrame:
    """(table, row) of the rows with cells that no group covers."""
    have = found.select("table", F.explode("covered").alias("row"))
    return cells.select("table", F.col("row").cast("int").alias("row")).distinct().join(have, ["table", "row"], "left_anti")
