"""Edits, split lines, caches and angles."""

import math
import random

import pytest
from pyspark.sql import functions as F

from textloom.operators import align, audit, stats
from textloom.sources import cache


def plain_edits(text, fragments):
    """Fragments that occur once, from the left, none over one that stays; replaced from the end."""
    at = sorted((text.index(old), len(old), old, new) for old, new in fragments if old and text.count(old) == 1)
    end, taken = 0, []
    for pos, n, _, new in at:
        if pos >= end:
            taken.append((pos, n, new))
            end = pos + n
    for pos, n, new in reversed(taken):
        text = text[:pos] + new + text[pos + n :]
    return text, len(taken), len(fragments) - len(taken)


def test_edits_are_applied(spark):
    rng = random.Random(6)
    files = {i: "".join(rng.choice("abcdefg ") for _ in range(rng.randrange(60))) for i in range(40)}
    fragments = []
    for i, t in files.items():
        for _ in range(rng.randrange(6)):
            a, n = rng.randrange(len(t) + 1), rng.randrange(5)
            fragments.append((i, t[a : a + n], rng.choice(["", "X", "longer than it was"])))
    fragments += [(0, "not there", "x"), (99, "a", "b"), (1, None, "x"), (2, "", "y")] + [f for f in fragments if f[0] == 3]  # repeated
    f = spark.createDataFrame(fragments, "file long, old string, new string")
    docs = spark.createDataFrame(list(files.items()), "file long, text string")
    listed = audit.settled(audit.edits(f, docs))
    assert {r["status"] for r in listed.collect()} >= {"ok", "overlap", "absent", "not unique", "missing file"} and listed.count() == len(fragments)
    got = {r["file"]: (r["text"], r["applied"], r["refused"]) for r in audit.applied(listed, docs).collect()}
    assert got == {i: plain_edits(t, [(old or "", new) for k, old, new in fragments if k == i]) for i, t in files.items()}


def test_touching_and_overlapping_edits(spark):
    docs = spark.createDataFrame([(1, "abcdefgh")], "file long, text string")
    f = spark.createDataFrame([(1, "bc", "1"), (1, "de", "2"), (1, "ef", "3"), (1, "h", "4"), (1, "a", "")], "file long, old string, new string")
    r = audit.applied(audit.settled(audit.edits(f, docs)), docs).first()
    assert (r["text"], r["applied"], r["refused"]) == ("12fg4", 4, 1)


def plain_rejoin(want, have):
    have, k, pieces = list(have), 0, [1] * len(have)
    while k < len(have) and k < len(want):
        if have[k] != want[k] and want[k].startswith(have[k]) and k + 1 < len(have):
            have[k] += have.pop(k + 1)
            pieces[k] += pieces.pop(k + 1)
            continue
        k += 1
    return list(zip(have, pieces, strict=True))


def test_pieces_are_joined_again(spark):
    rng = random.Random(7)
    pages = {}
    for p in range(30):
        lines = ["".join(rng.choice("ab ") for _ in range(rng.randrange(12))) for _ in range(rng.randrange(15))]
        have = []
        for x in lines:
            cuts = sorted(rng.randrange(len(x) + 1) for _ in range(rng.choice([0, 0, 1, 2])))
            parts = [x[a:b] for a, b in zip([0, *cuts], [*cuts, len(x)], strict=True)]
            have += parts if rng.random() < 0.9 else ["other"]
        pages[p] = lines, have
    frame = lambda k: spark.createDataFrame([(p, i, x) for p, both in pages.items() for i, x in enumerate(both[k])], "page int, rank long, text string")
    got = {}
    for r in align.rejoined(frame(0), frame(1).repartition(3), ["page"]).orderBy("page", "rank").collect():
        got.setdefault(r["page"], []).append((r["text"], r["pieces"]))
    assert got == {p: plain_rejoin(*both) for p, both in pages.items() if both[1]}


def test_only_lines_that_may_split(spark):
    want = spark.createDataFrame([(1, 1, "ab", True), (1, 2, "cd", False)], "page int, rank long, text string, row boolean")
    have = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 3, "c"), (1, 4, "d"), (2, 1, "x")], "page int, rank long, text string")
    got = [(r["page"], r["rank"], r["text"]) for r in align.rejoined(want, have, ["page"], splits=F.col("row")).orderBy("page", "rank").collect()]
    assert got == [(1, 1, "ab"), (1, 2, "c"), (1, 3, "d"), (2, 1, "x")]


def test_a_cache_computes_what_has_changed(spark, tmp_path):
    path, seen = str(tmp_path / "cache"), spark.sparkContext.accumulator(0)

    def compute(d):
        return d.select("k", F.upper("v").alias("up"))

    rows = {i: f"v{i}" for i in range(40)}
    source = lambda: spark.createDataFrame([(k, v, None) for k, v in rows.items()], "k long, v string, none string")
    run = lambda: tuple(cache.refresh(source(), "k", compute, path, parts=16).first())
    assert run() == (40, 0, 0, 16)
    stamps = {p: p.stat().st_mtime_ns for p in (tmp_path / "cache").rglob("*.parquet")}
    assert run() == (0, 40, 0, 0)
    assert stamps == {p: p.stat().st_mtime_ns for p in (tmp_path / "cache").rglob("*.parquet")}
    rows |= {1: "x", 2: "y", 18: "z"}  # two of one partition
    del rows[7]
    rows[100] = "new"
    assert run() == (4, 36, 1, 4) and seen.value == 0
    kept = {p for p in (tmp_path / "cache").rglob("*.parquet") if p in stamps}
    assert {p.parent.name for p in stamps} - {p.parent.name for p in kept} == {"_part=1", "_part=2", "_part=4", "_part=7"}
    assert {r["k"]: r["up"] for r in cache.read(spark, path).collect()} == {k: v.upper() for k, v in rows.items()}
    rows[7] = "back"
    assert run() == (1, 40, 0, 1) and cache.read(spark, path).count() == 41


def test_circular_means(spark):
    rng = random.Random(8)
    groups = {1: [rng.uniform(0, 360) for _ in range(30)], 2: [350, 10, 0], 3: [5.0], 4: [None], 5: [a + 60 * k for k in range(6) for a in (14.5, 15.5)]}
    d = spark.createDataFrame([(g, None if a is None else float(a)) for g, xs in groups.items() for a in xs], "g int, a double")
    for harmonic in (1, 6):
        for r in stats.circular_mean(d, F.col("a"), ["g"], harmonic).collect():
            xs = [a for a in groups[r["g"]] if a is not None]
            if not xs:
                assert r["mean"] is None and r["concentration"] is None and r["n"] == 0
                continue
            z = sum(complex(math.cos(math.radians(harmonic * a)), math.sin(math.radians(harmonic * a))) for a in xs)
            assert math.isclose(abs(z) / len(xs), r["concentration"], abs_tol=1e-12)
            if abs(z) > 1e-6:
                away = abs(math.degrees(math.atan2(z.imag, z.real)) / harmonic - r["mean"]) % (360 / harmonic)
                assert min(away, 360 / harmonic - away) < 1e-9


@pytest.mark.parametrize("most", [1, 6])
def test_extremes_apart(spark, most):
    rng = random.Random(9)
    rows = [(g, rng.choice([rng.uniform(-50, 400), 90.0, 91.0]), rng.choice([rng.random(), 0.5])) for g in range(3) for _ in range(60)] + [(7, 359.0, 1.0), (7, 3.0, 0.9), (7, 25.0, 0.8), (8, None, 1.0), (9, 1.0, None)]

    def plain(g):
        taken = []
        for _, a in sorted((-v, a) for k, a, v in rows if k == g and a is not None and v is not None):
            if len(taken) < most and all(min(abs(a - p) % 360, 360 - abs(a - p) % 360) > 25 for p in taken):
                taken.append(a)
        return taken

    got = {}
    for r in stats.apart(spark.createDataFrame(rows, "g int, a double, v double"), "a", "v", ["g"], most).orderBy("g", "nth").collect():
        got.setdefault(r["g"], []).append(r["a"])
    assert got == {g: plain(g) for g in (0, 1, 2, 7)}


def test_edit_where_its_fragment_was_found(spark):
    docs = spark.createDataFrame([(1, "abababx")], "file long, text string")
    f = spark.createDataFrame([(1, 3, "abab", "-")], "file long, at int, old string, new string")
    done = lambda x: audit.applied(audit.settled(audit.edits(x, docs)), docs).first()["text"]
    assert done(f) == "ab-x" and done(f.drop("at")) == "-abx" and done(f.withColumn("at", F.lit(2))) == "-abx"
