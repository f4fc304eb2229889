"""Hard negatives, centroid clustering, and near-duplicates by Golay codes."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from textloom.llm import centroids, common, fuzzy, golay, negatives, vectors

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
VECTORS = "vec_id long, label int, embedding array<float>, v string, leaf int, block string, cluster string, distance string, n int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", "z", "d", 2) for r in rows], VECTORS)


# hard negatives


def brute_negatives(rows, anchor, positives=5, negatives_=5):
    ok = [(i, lab, np.floor(256 * np.array(e, np.float32).astype(float)).astype(np.int64)) for i, lab, e in rows if i is not None and lab is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)]
    width = max((len(v) for _, _, v in ok), default=0)
    ok = [(i, lab, np.pad(v, (0, width - len(v)))) for i, lab, v in ok]
    out, done = [], set()
    for k, (i, lab, v) in enumerate(ok):
        key = i, lab, tuple(v)
        if not anchor(i) or key in done:
            continue
        done.add(key)
        scores = [(-int(v @ w), j, other) for m, (j, other, w) in enumerate(ok) if m != k]
        for p, j, _ in sorted(s for s in scores if s[2] == lab)[:positives]:
            fit = sorted(s for s in scores if s[2] != lab and 80 * -p <= 100 * -s[0] <= 100 * -p)[:negatives_]
            out += [(i, j, r + 1, b, -p, -s) for r, (s, b, _) in enumerate(fit)]
    return sorted(out)


def mined(df):
    return sorted(tuple(r) for r in negatives.mined(df, F.col("vec_id") % 5 == 0).collect())


@pytest.fixture
def small_trees(monkeypatch):
    """Trees of several levels over a few hundred rows."""
    for k, x in {"BLOCK": 40, "LEAF": 8, "ANCHORS": 12, "ANCHOR_LEAF": 3}.items():
        monkeypatch.setattr(negatives, k, x)


def test_negatives_as_brute_force(spark, small_trees):
    rng = np.random.default_rng(5)
    middles = rng.normal(size=(6, 9)) * 2
    near = rng.integers(0, 6, 400)
    rows = [(int(i), int(near[i] if i % 11 else i % 3), (middles[near[i]] + rng.normal(size=9) * (0.01 if i % 4 else 0.8)).tolist()) for i in range(400)]
    rows += [(1000 + i, 2, middles[1].tolist()) for i in range(150)]  # one vector has a good part of all rows
    assert mined(table(spark, rows)) == brute_negatives(rows, lambda i: i % 5 == 0)


def test_negatives_with_odd_rows(spark, small_trees):
    rng = np.random.default_rng(6)
    rows = [(i, i % 3, rng.normal(size=4).tolist()) for i in range(60)]
    rows += [rows[10]] * 3 + [rows[7]] * 9 + [(10, 2, rng.normal(size=4).tolist()), (200, 9, [1.0] * 4)]  # copies, one id twice, a label of one row
    rows += [(300, 1, None), (305, None, [1.0] * 4), (310, 1, [1.0, None, 1.0, 1.0]), (315, 1, [float("nan")] * 4), (320, 1, [float("inf")] * 4), (None, 1, [5.0] * 4), (325, 1, [0.5, 0.5]), (330, 2, [])]
    got = mined(table(spark, rows))
    assert got == brute_negatives(rows, lambda i: i % 5 == 0) and not {300, 305, 310, 315, 320, 200} & {r[0] for r in got}
    assert mined(table(spark, rows).where("false")) == []
    assert mined(table(spark, [(5, 1, [1.0]), (6, 1, [1.0])])) == [] and mined(table(spark, [(5, 1, [])])) == []


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(7)
    a, c = (rng.normal(size=(8, 1, 5)) * 200 + rng.normal(size=(8, 30, 5)) * 20 for _ in range(2))
    a, c = a.astype(np.int64), c.astype(np.int64)

    def node(x):
        low, high = x.min(1), x.max(1)
        middle = (low + high) / 2
        return {"low": low, "high": high, "middle": middle, "radius": np.sqrt(((x - middle[:, None]) ** 2).sum(2).max(1))}

    one = lambda x, s: {k: v[s] for k, v in x.items()}
    lo, up = negatives.products(one(node(a), np.s_[:, None]), one(node(c), np.s_[None]))
    products = np.einsum("aik,cjk->acij", a, c)
    assert (lo <= products.min((2, 3))).all() and (products.max((2, 3)) <= up).all()
    assert (up < np.median(products)).any()


def test_products_beyond_doubles_are_exact():
    a = np.array([[vectors.LARGEST - 1] * 4, [1, 2, 3, 4]])
    assert negatives.exact(a, a).tolist() == [[int(sum(x * y for x, y in zip(p, q, strict=True))) for q in a.tolist()] for p in a.tolist()]


def test_leaf_nodes_hold_every_row():
    rows = np.random.default_rng(8).integers(-9, 9, (77, 3))
    for x in (rows, np.zeros((77, 3), np.int64), rows[:1]):
        order, ends = negatives.nodes(x, 10)
        assert sorted(order) == list(range(len(x))) and ends[-1] == len(x) and np.diff([0, *ends]).max() <= 10


# clustering


def brute_lloyd(rows, size, centres, rounds):
    ok = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in e]) for i, e in rows if e is not None and len(e) == size and all(x is not None and np.isfinite(x) for x in e)]
    name = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    c = [v for _, v in sorted(((name(i), v) for i, v in ok))[:centres]]
    far = lambda v, w: sum((x - y) ** 2 for x, y in zip(v, w, strict=True))
    near = lambda v: min((far(v, w), k) for k, w in enumerate(c))
    for _ in range(rounds):
        got = [near(v)[1] for _, v in ok]
        c = [[sum(col) // got.count(k) for col in zip(*[v for g, (_, v) in zip(got, ok, strict=True) if g == k], strict=True)] if k in got else w for k, w in enumerate(c)]
    last = [(i, *near(v)[::-1]) for i, v in ok]
    total = lambda k: sum(d for _, g, d in last if k in (None, g))
    return sorted((repr(i), k, d, total(k), total(None), hashlib.sha256(",".join(map(str, c[k])).encode()).hexdigest()) for i, k, d in last)


def clusters(df, **more):
    return sorted((repr(r[0]), *r[1:]) for r in centroids.clustered(df, **more).collect())


def test_lloyd_as_written_out(spark):
    rng = np.random.default_rng(9)
    points = [(i, (rng.normal(size=6) + 3 * (i % 4)).tolist()) for i in range(120)] + [(500 + i, [0.25] * 6) for i in range(60)]
    points += [(3, points[3][1]), (3, [9.0] * 6), (None, [1.0] * 6), (None, [-1.0] * 6)]  # a repeated row, an id twice, no id
    odd = [(600, None), (601, [1.0] * 5), (602, [1.0] * 7), (603, [None] + [1.0] * 5), (604, [float("nan")] * 6), (605, [float("-inf")] * 6), (606, [])]
    df = table(spark, [(i, 0, e) for i, e in points + odd])
    assert clusters(df, size=6, centres=12) == brute_lloyd(points + odd, 6, 12, 5)
    assert clusters(df.repartition(7), size=6, centres=12) == clusters(df.coalesce(1), size=6, centres=12)


def test_lloyd_with_few_points_and_empty_centres(spark):
    rows = [(1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [-2.0, 0.5]), (4, [1.0, 1.0])]  # equal centres: all points go to the first of them
    df = table(spark, [(i, 0, e) for i, e in rows])
    assert clusters(df, size=2, centres=40) == brute_lloyd(rows, 2, 40, 5)
    none = centroids.clustered(df.where("false"), size=2)
    assert none.count() == 0 and none.columns == centroids.clustered(df, size=2).columns and clusters(df, size=3) == []


def test_components_too_large_are_an_error(spark):
    with pytest.raises(Exception, match="components must be smaller"):
        centroids.clustered(table(spark, [(1, 0, [1e30, 0.0])]), size=2)


# near-duplicates


def test_golay_keys_are_the_near_codewords():
    parity, _, n = golay.tables()
    code = np.arange(1 << golay.DATA) << golay.PARITY | parity
    assert sorted(set(np.bitwise_count(code.astype(np.uint32)).tolist())) == [0, 7, 8, 11, 12, 15, 16, 23] and set(n) == {1, 6}
    words = np.random.default_rng(1).integers(0, 1 << golay.LENGTH, 300)
    i, key = golay.keys(words)
    for k, w in enumerate(words):
        assert set(key[i == k]) == set(np.flatnonzero(np.bitwise_count((code ^ w).astype(np.uint32)) <= golay.REACH))


def test_every_two_errors_leave_a_common_key():
    rng = np.random.default_rng(2)
    for own in (0, (1 << 64) - 1, *(int(rng.integers(0, 1 << 63)) * 2 + 1 for _ in range(2))):
        others = [own] + [own ^ sum(1 << b for b in bits) for n in (1, 2) for bits in itertools.combinations(range(64), n)]
        i, key = fuzzy.fuzzy_keys(np.array(others, np.uint64))
        mine = key[i == 0]
        assert set(i[np.isin(key, mine)]) == set(range(len(others)))


def print_of(text):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    h = [xxhash.xxh64(" ".join(w[i : i + 3]).encode(), seed=42).intdigest() for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(found):
    """found: (doc_id, fingerprint); the least id of each row's component, nulls last."""
    root = list(range(len(found)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    prints = np.array([p for _, p in found], np.uint64)
    for k in range(len(found)):
        for j in np.flatnonzero(np.bitwise_count(prints[:k] ^ prints[k]) <= 2):
            root[find(k)] = find(int(j))
    least = {}
    for k, (i, _) in enumerate(found):
        x = least.get(find(k))
        least[find(k)] = x if i is None else i if x is None else min(x, i)
    return sorted(map(repr, ((i, p, least[find(k)]) for k, (i, p) in enumerate(found))))


def test_near_duplicates_over_documents(documents):
    want = brute_components([(r["doc_id"], print_of(r["text"])) for r in documents.collect()])
    assert sorted(repr((r["doc_id"], int(r["fingerprint"], 16), r["component_id"])) for r in fuzzy.join(documents).collect()) == want


def test_near_duplicates_over_odd_rows(odd, empty):
    want = brute_components([(r["doc_id"], print_of(r["text"])) for r in odd.collect()])
    assert sorted(repr((r["doc_id"], int(r["fingerprint"], 16), r["component_id"])) for r in fuzzy.join(odd).collect()) == want
    assert fuzzy.join(empty).count() == 0


@pytest.mark.parametrize("small", [2, 64])
def test_large_buckets_lose_no_link(spark, small):
    """Crowds around a word, chains, and many rows of one fingerprint: by pairs and by the words between."""
    rng = random.Random(3)
    own = [0, rng.getrandbits(64), rng.getrandbits(64)]
    prints = [p ^ sum(1 << b for b in rng.sample(range(64), rng.choice([0, 1, 2, 3, 4]))) for p in own for _ in range(150)]
    at = rng.getrandbits(64)
    for _ in range(40):  # a chain of steps of two bits
        at ^= sum(1 << b for b in rng.sample(range(64), 2))
        prints.append(at)
    prints += [own[1]] * 300 + [rng.getrandbits(64) for _ in range(50)]
    found = [(i if i % 50 else None, p) for i, p in enumerate(prints)]
    df = spark.createDataFrame([(i, p - (p >> 63 << 64)) for i, p in found], "doc_id long, fingerprint long")
    got = fuzzy.components(df, small).collect()
    assert sorted(repr((r["doc_id"], r["fingerprint"] % (1 << 64), r["component_id"])) for r in got) == brute_components(found)


def test_vectors_leave_other_columns_out(spark):
    got = vectors.vectors(table(spark, [(1, 2, [0.5, -0.001]), (2, 1, None)]), "vec_id")
    assert got.columns == ["vec_id", "v"] and [tuple(r) for r in got.collect()] == [(1, [128, -1])]


def test_vectors_queries_are_there():
    from textloom.llm import queries

    assert {"op11_dual_tree_negatives", "op12_golay_fuzzy", "op13_lloyd"} <= set(queries.queries()) and common.ROOT
