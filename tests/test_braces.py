"""Braces of tables against a plain reading of each table."""

import random
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textloom.operators import braces, bracerows
from textloom.plans import pages

PITCH = 4.0
CELLS = "table int, row int, ord int, x double, kind string, height double, gap double, text string"


def plain_leaders(row):
    """row: cells as dicts, in order."""
    merged = []
    for c in row:
        if c["text"] == "." and c["kind"] is None and merged and merged[-1]["kind"] is None and set(merged[-1]["text"]) == {"."}:
            merged[-1] = merged[-1] | {"text": merged[-1]["text"] + "."}
        else:
            merged.append(dict(c))
    line = []
    for c in merged:
        if c["kind"] is None and set(c["text"]) == {"."} and len(c["text"]) > 1:
            c["kind"] = "leader"
            if line and line[-1]["kind"] not in braces.BRACES:
                line[-1]["text"] += " " + c["text"]
                continue
        line.append(c)
    return line


def span(c, r, total):
    n = max(1, round(c["height"] / PITCH))
    a = round(r - c["gap"] / PITCH - (n - 1) / 2)
    return range(max(0, min(a, total - n)), max(0, min(a, total - n)) + n)


def cover(g, gs):
    return set(g["rows"]) | {g["at"]} | {r for h in gs if h["parent"] is g for r in cover(h, gs)}


def plain_groups(rows):
    gs, total = [], len(rows)
    for r, row in enumerate(rows):
        for c in row:
            if c["kind"] in ("open", "up"):
                own = span(c, r, total) if c["kind"] == "open" else [r]
                cells = [(q, d) for q in own if q < total for d in rows[q] if d["x"] < c["x"]]
                some = [(q, d) for q, d in cells if d["kind"] is None] or [(q, d) for q, d in cells if d["kind"] == "leader"]
                if c["kind"] == "up":
                    some = [(r - 1, d) for d in (rows[r - 1] if r else []) if d["kind"] is None][-1:]
                if some:
                    at, title = max(some, key=lambda x: x[1]["x"]) if c["kind"] == "open" else some[0]
                    gs.append({"brace": c, "r": r, "rows": list(own), "x": c["x"], "title": title, "at": at, "parent": None, "closed": None})
    for g in gs:
        up = [h for h in gs if h is not g and h["x"] < g["x"] and g["at"] in h["rows"] and h["title"] is not g["title"]]
        g["up"] = min(up, key=lambda h: len(h["rows"])) if up else None
    for g in gs:
        g["parent"] = g["up"]
    more = []
    for r, row in enumerate(rows):
        for c in row:
            if c["kind"] == "close":
                own = span(c, r, total)
                right = [(q, d) for q in own if q < total for d in rows[q] if d["x"] > c["x"] and d["kind"] is None]
                if not right:
                    continue
                at, title = min(right, key=lambda x: x[1]["x"])
                inside = [h for h in gs if cover(h, gs) <= set(own)]
                roots = [h for h in inside if not any(h["up"] is i for i in inside)]
                if len(roots) == 1 and cover(roots[0], gs) == set(own):
                    roots[0]["closed"] = title["text"]
                    continue
                more.append(({"brace": c, "r": r, "rows": list(own), "x": c["x"], "title": title, "at": at, "parent": roots[0]["up"] if roots else None, "closed": None}, roots))
    for g, roots in more:
        for h in roots:
            h["parent"] = g
    return gs + [g for g, _ in more]


def random_table(rng, closers):
    rows, left = [], closers
    for _ in range(rng.randrange(1, 7)):
        row, x = [], 0.0
        for _ in range(rng.randrange(0, 7)):
            x += rng.choice([3.0, 5.0])
            kind = rng.choices([None, "open", "up", "dot"], [6, 3, 1, 3])[0]
            if left and rng.random() < 0.2:
                kind, left = "close", left - 1
            text = "." if kind == "dot" else "" if kind else rng.choice(["a", "b", "..", "word"])
            row.append({"x": x, "kind": None if kind == "dot" else kind, "height": rng.choice([0, 4, 7, 8, 13]) * 1.0 if kind else 0.0, "gap": rng.choice([-4, 0, 2, 5]) * 1.0 if kind else 0.0, "text": text})
        rows.append(row)
    rows[-1].append({"x": 50.0, "kind": None, "height": 0.0, "gap": 0.0, "text": "end"})
    return rows


def test_tables_as_read_one_by_one(spark):
    rng = random.Random(11)
    tables = {t: random_table(rng, t % 2) for t in range(80)}  # one closing brace at most: two in a table do not see each other
    cells = spark.createDataFrame([(t, r, k, c["x"], c["kind"], c["height"], c["gap"], c["text"]) for t, rows in tables.items() for r, row in enumerate(rows) for k, c in enumerate(row)], CELLS).repartition(3)
    merged = braces.merged_leaders(cells).cache()
    got = {}
    for x in merged.orderBy("table", "row", "ord").collect():
        got.setdefault((x["table"], x["row"]), []).append((x["x"], x["kind"], x["text"]))
    plain = {t: [plain_leaders(row) for row in rows] for t, rows in tables.items()}
    assert got == {(t, r): [(c["x"], c["kind"], c["text"]) for c in row] for t, rows in plain.items() for r, row in enumerate(rows) if row}
    found = braces.groups(merged, PITCH).cache()
    name = {r["id"]: (r["row"], r["x"]) for r in found.collect()}
    got = sorted(repr((r["table"], r["row"], r["x"], r["kind"], r["title"], r["title_row"], name.get(r["parent"]), r["closed_by"], r["covered"])) for r in found.collect())
    want, open_rows = [], set()
    for t, rows in plain.items():
        gs = plain_groups(rows)
        want += [repr((t, g["r"], g["x"], g["brace"]["kind"], g["title"]["text"], g["at"], (g["parent"]["r"], g["parent"]["x"]) if g["parent"] else None, g["closed"], sorted(cover(g, gs)))) for g in gs]
        open_rows |= {(t, r) for r, row in enumerate(rows) if row} - {(t, r) for g in gs for r in cover(g, gs)}
    assert got == sorted(want) and sum("'close'" in w for w in want) > 3
    assert {(r["table"], r["row"]) for r in braces.uncovered(cells, found).collect()} == open_rows


def as_rows(cells):
    cell = F.struct("x", "kind", "height", "gap", "text")
    rows = cells.groupBy("table", "row").agg(F.array_sort(F.collect_list(F.struct("ord", cell.alias("c"))))["c"].alias("cells"))
    # a null before and behind: no cells
    return rows.withColumn("cells", F.concat(F.array(F.lit(None).cast("struct<x:double,kind:string,height:double,gap:double,text:string>")), "cells", F.array(F.lit(None))))


def read_off(found):
    columns = ["table", "id", "kind", "row", "ord", "x", "first", "n", "title", "title_row", "title_cell", "parent", "closed_by", "covered"]
    assert found.columns == columns
    return sorted(map(repr, found.collect()))


@pytest.mark.parametrize("closers", [1, 6])
def test_rows_of_whole_tables_give_the_same_groups(spark, monkeypatch, closers):
    """In batches, in chunks and parts of few cells, and with larger tables put aside: always what the joined reading gives, nulls and several closing braces included."""
    rng = random.Random(closers)
    tables = {t: random_table(rng, t % 2 * closers) for t in range(60)}
    cells = [[t, r, k, c["x"], c["kind"], c["height"], c["gap"], c["text"]] for t, rows in tables.items() for r, row in enumerate(rows) for k, c in enumerate(row)]
    for c in cells[::7]:
        c[rng.choice([5, 6, 7])] = None
    for c in cells[::31]:
        c[7] = rng.choice(["..\n", ".\n", "é.", " ", ""])
    cells = spark.createDataFrame([*cells, [None, 0, 0, 1.0, None, 0.0, 0.0, "a"], [None, 0, 1, 2.0, "open", 0.0, 0.0, ""]], CELLS).repartition(3).cache()
    want = read_off(braces.groups(braces.merged_leaders(cells), PITCH))
    assert len(want) > 100 and sum("closed_by=None" not in w for w in want) > 0
    rows = as_rows(cells).cache()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert read_off(braces.row_groups(rows, PITCH)) == want
        assert read_off(braces.row_groups(rows, PITCH, most=20)) == want  # both ways
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    batch = pa.Table.from_batches(rows.where("table is not null").withColumn("n", F.lit(1)).orderBy("table").toArrow().to_batches()).combine_chunks().to_batches()[0]
    whole = sorted(map(repr, pa.Table.from_batches(list(bracerows.reader(PITCH, 1)(iter([batch])))).to_pylist()))
    monkeypatch.setattr(bracerows, "CHUNK", 9)
    monkeypatch.setattr(bracerows, "PAIRS", 3)
    assert sorted(map(repr, pa.Table.from_batches(list(bracerows.reader(PITCH, 1)(iter([batch.slice(0, 5), batch.slice(5)])))).to_pylist())) == whole and len(whole) == len(want)


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="no tables here")
def test_orders_are_read_in_a_few_jobs(spark):
    """table_groups shuffles its line items once; it took a job and a table for each step and level."""
    spark.sparkContext.setJobGroup("table_groups", "")
    try:
        found = pages.table_groups(spark, "/root/testdata/sf0.001").collect()
        assert len(found) > 1000 and len(spark.sparkContext.statusTracker().getJobIdsForGroup("table_groups")) <= 8
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    cells = pages.order_rows(spark, "/root/testdata/sf0.001").select("table", "row", F.posexplode(F.array_compact("cells")).alias("ord", "c")).select("table", "row", "ord", "c.*")
    want = braces.groups(braces.merged_leaders(cells), 4.0).withColumn("covered", F.array_join(F.col("covered").cast("array<string>"), ","))
    assert sorted(map(repr, found)) == sorted(map(repr, want.select(*found[0].__fields__).collect()))
