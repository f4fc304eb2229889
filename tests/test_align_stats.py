"""Votes, scored matches and picked ranks against their definitions."""

import math
import random
import tracemalloc

import numpy as np
import pytest

from textloom.operators import align, stats


def votes_of(x, y, o, reach):
    return int((np.abs((x + o)[:, None] - y) <= reach).any(1).sum())


def by_definition(x, y, reach):
    return min((-votes_of(x, y, o, reach), o) for o in np.unique(y[None, :] - x[:, None]))[1]


@pytest.mark.parametrize("cells", [8, 1 << 20])
def test_votes_as_defined(cells):
    rng = np.random.default_rng(1)
    for _ in range(80):
        x, y = (rng.integers(0, 400, rng.integers(1, 30)).astype(float) for _ in range(2))
        assert align.voted(x, y, 10.0, cells) == by_definition(x, y, 10.0)


def plain_match(x, y, reach, gap):
    """The whole matrix, cell by cell."""
    n, m = len(x), len(y)
    best, came = np.zeros((n + 1, m + 1)), np.zeros((n + 1, m + 1), int)
    best[:, 0], best[0] = gap * np.arange(n + 1), gap * np.arange(m + 1)
    came[1:, 0], came[0, 1:] = 1, 2
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            ways = [(best[i - 1, j] + gap, 1), (best[i, j - 1] + gap, 2)]
            if abs(x[i - 1] - y[j - 1]) <= reach:
                ways.append((best[i - 1, j - 1] + reach - abs(x[i - 1] - y[j - 1]), 3))
            top = max(v for v, _ in ways)
            best[i, j], came[i, j] = next(w for w in ways if w[0] == top)
    i, j, out = n, m, []
    while i or j:
        k = came[i, j]
        if k == 3:
            out.append((i - 1, j - 1))
        i, j = i - (k != 2), j - (k != 1)
    return out[::-1]


def test_scored_as_defined():
    rng = np.random.default_rng(2)
    for _ in range(80):
        x, y = (np.sort(rng.integers(0, 500, rng.integers(1, 25))).astype(float) for _ in range(2))
        want = plain_match(x + by_definition(x, y, 10.0), y, 10.0, -1.0)
        assert align.scored(x, y) == align.scored(x, y, cells=1) == align.scored(x, y, cells=50) == want


def test_scored_on_long_pages_in_bounded_memory():
    ix = np.arange(5000)
    rng = np.random.default_rng(3)
    x = ix * 40.0 + rng.integers(-3, 4, 5000)
    keep = ix % 7 != 3
    tracemalloc.start()
    got = align.scored(x, x[keep] + 25)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == [(int(i), k) for k, i in enumerate(ix[keep])] and most < 400 << 20


def ranks(n):
    return {"first": lambda c: c - c, "last": lambda c: c - 1, "mid": lambda c: (c - 1) / 2}


@pytest.mark.parametrize(("ranges", "small"), [(4096, 4096), (8, 4), (3, 2)])
def test_picked_ranks(spark, monkeypatch, ranges, small):
    """With few ranges it takes several turns, and the answer stays."""
    monkeypatch.setattr(stats, "RANGES", ranges)
    monkeypatch.setattr(stats, "SMALL", small)
    monkeypatch.setattr(stats, "BROADCAST", 2 if ranges == 3 else 10_000)
    rng = np.random.default_rng(4)
    groups = {
        1: rng.lognormal(size=150).tolist(), 2: [5.0] * 60, 3: [7.0], 4: (rng.integers(0, 4, 90) / 2).tolist() + [1e300, -1e300], 5: [float("-inf"), 1.0, 2.0, float("inf"), float("nan"), float("nan")], 6: [1.0] * 40 + [1.0 + 1e-12] * 3,
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [(1, None), (None, 2.0), (9, None)]
    got = {r["g"]: r for r in stats.picked(spark.createDataFrame(rows, "g int, v double").repartition(3), "v", ["g"], ranks(0)).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        s = sorted(vs, key=lambda v: (math.isnan(v), v))
        assert repr((got[g]["first"], got[g]["mid"], got[g]["last"], got[g]["_n"])) == repr((s[0], s[(len(s) - 1) // 2], s[-1], len(s)))


def test_picked_whole_numbers_and_empty(spark):
    d = spark.createDataFrame([("a", i % 1000) for i in range(5000)], "g string, v long")
    r = stats.picked(d, "v", ["g"], {"x": lambda n: n / 10}).collect()
    assert [tuple(x) for x in r] == [("a", 100, 5000)]
    assert stats.quantiles(d.where("false"), "v", ["g"], {"m": 0.5}).count() == 0


def test_no_window_over_a_groups_values(spark):
    """The windows that are left run over ranges."""
    d = spark.range(1000).selectExpr("id % 3 as g", "cast(id as double) as v")
    plan = stats.quantiles(d, "v", ["g"], {"m": 0.5})._jdf.queryExecution().toString()
    assert "Window" not in plan


def test_offsets_of_pages(spark):
    a = {1: [0, 40, 80, 80], 2: [5], 3: [1, 2]}
    b = {1: [13, 53, 93], 2: [100, 130], 4: [7]}
    frame = lambda x: spark.createDataFrame([(p, y) for p, ys in x.items() for y in ys], "page int, y int")
    got = {r["page"]: (r["offset"], r["votes"]) for r in stats.best_offset(frame(a), frame(b), ["page"]).collect()}

    def plain(xs, ys):
        return min((-sum(any(abs(x + o - y) <= 10 for y in ys) for x in set(xs)), o) for o in range(-300, 300))

    assert got == {p: (o, -v) for p in (1, 2) for v, o in [plain(a[p], b[p])]}


def test_distances_in_bands_are_exact(spark):
    import random

    rng = random.Random(1)
    rows = [("", ""), (None, "a"), ("a", None)]
    for _ in range(80):
        a = "".join(rng.choice("abcé ") for _ in range(rng.choice([0, 3, 60, 300])))
        b = list(a)
        for _ in range(rng.choice([0, 2, 40, 200]) if b else 0):
            b[rng.randrange(len(b))] = rng.choice(["", "x", "yy"])
        rows.append((a, "".join(b)))

    def apart(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            row, old = [i + 1], row
            for j, y in enumerate(b):
                row.append(min(old[j] + (x != y), old[j + 1] + 1, row[j] + 1))
        return row[-1]

    d = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string")
    got = d.selectExpr("i", "a", "b").select("i", align.distance(d["a"], d["b"], 4).alias("d"), align.distance(d["a"], d["b"]).alias("e")).orderBy("i").collect()
    want = [None if a is None or b is None else apart(a, b) for a, b in rows]
    assert [r["d"] for r in got] == [r["e"] for r in got] == want


def test_pages_are_matched_in_batches(spark):
    points = [(1, "a", 2, 40.0), (1, "a", 1, 0.0), (1, "b", 5, 1.0), (1, "b", 9, 41.0), (2, "b", 7, 3.0), (3, "a", 4, 3.0)]
    got = align.aligned(spark.createDataFrame(points, "page long, side string, ix int, y double"))
    assert "GroupsInPandas" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, got.collect()), key=repr) == [(1, 1, 5), (1, 2, 9), (2, None, 7), (3, 4, None)]


def test_distances_by_bits_and_by_edits():
    rng = random.Random(11)
    for _ in range(200):
        a = "".join(rng.choice("abé😀") for _ in range(rng.randrange(1, 90)))
        b = "".join(rng.choice("abé😀") if rng.random() < 0.2 else c for c in a)[rng.randrange(3) :] + "x" * rng.randrange(4)
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        assert align.bit_distance(a, b) == row[-1]
        assert [align.near_distance(a, b, m) for m in (3, 200)] == [row[-1] if row[-1] <= 3 else None, row[-1]]


def test_long_texts_that_are_alike_take_no_matrix():
    text = "".join(random.Random(3).choices("abcdefgh ", k=300000))
    assert align.near_distance(text, text[:1000] + "X" + text[1000:-5], 100) == 6
