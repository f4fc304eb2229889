"""Hard negatives by a dual-tree search for largest inner products.

Anchors and candidates are put into trees of their own: a bounded sample fixes
the upper splits, every row goes to its leaf, a leaf's rows are cut into blocks
of bounded size by a hash, and each block has a tree of its own. A node knows
the least and greatest value of each component and a ball around its middle;
both bound the inner products between two nodes' vectors. Pairs of leaves,
of blocks, and of nodes inside blocks are given up at once if no product of
theirs can be among the wanted ones; what is left at the leaf nodes is computed
in exact integers.

The wanted products of an anchor are windows: for its positives everything from
the fifth best known so far on; for the negatives of a positive, shares of its
score. Each search begins with the most promising block of each block of
anchors, whose fifth best products narrow the windows for all others.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common, vectors

POSITIVES, NEGATIVES, LOW, HIGH = 5, 5, 80, 100
#: Rows of a block and of a leaf node, of candidates and of anchors; levels of splits that a sample of so many rows fixes at most.
BLOCK, LEAF, ANCHORS, ANCHOR_LEAF, LEVELS, SAMPLE = 1024, 128, 256, 16, 10, 8192
BLOCKS = "leaf int, block long, n int, ids binary, labels binary, copies binary, vectors binary, ends binary, low binary, high binary, middle binary, radius binary"
FAR = 1 << 62


class Splits:
    """A binary tree of hyperplanes, fitted to a sample; level by level, a direction and a threshold for each node."""

    def __init__(self, sample: np.ndarray, levels: int):
        self.levels, self.planes = levels, []
        where = np.zeros(len(sample), np.int64)
        for level in range(levels):
            planes = [_halves(sample[where == i]) for i in range(1 << level)]
            self.planes.append((np.array([p for p, _ in planes]), np.array([t for _, t in planes])))
            where = self._down(sample, where, level)

    def _down(self, rows: np.ndarray, where: np.ndarray, level: int) -> np.ndarray:
        directions, thresholds = self.planes[level]
        return where * 2 + (np.einsum("ij,ij->i", rows, directions[where]) > thresholds[where])

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        where = np.zeros(len(rows), np.int64)
        for level in range(self.levels):
            where = self._down(rows.astype(np.float64), where, level)
        return where


def _halves(rows: np.ndarray) -> tuple[np.ndarray, float]:
    """A direction in which rows spread much (three turns of the power method), and where it halves them."""
    width = rows.shape[1]
    away = rows - rows.mean(0) if len(rows) else rows
    line = away[np.argmax(np.einsum("ij,ij->i", away, away))].astype(np.float64) if len(rows) else np.zeros(width)
    for _ in range(3):
        line = away.T @ (away @ line)
        size = np.linalg.norm(line)
        line = line / size if size else line
    return line, float(np.median(rows @ line)) if len(rows) else 0.0


def nodes(rows: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, ends): rows in the order of a binary tree cut by halves to leaf rows at most, and where the leaf nodes end; the number of leaf nodes is a power of two, some may be empty."""
    parts = [np.arange(len(rows))]
    while max(map(len, parts)) > leaf:
        cut = []
        for p in parts:
            line, _ = _halves(rows[p])
            p = p[np.argsort(rows[p] @ line, kind="stable")]
            cut += [p[: len(p) // 2], p[len(p) // 2 :]]
        parts = cut
    return np.concatenate(parts), np.cumsum([len(p) for p in parts])


def _blocked(leaf_size: int, width: int, key: tuple, t: pa.Table) -> pa.Table:
    """A block from its rows (vec_id, label, copies, v): a row with its rows in the order of the leaf nodes, the node around all of them, and the leaf nodes."""
    v = vectors.matrix(t.column("v").combine_chunks(), width)
    order, ends = nodes(v, leaf_size)
    v = v[order]
    bounds = [(0, len(v)), *zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
    low = np.array([v[a:z].min(0) if z > a else np.zeros(width, np.int64) for a, z in bounds])
    high = np.array([v[a:z].max(0) if z > a else np.zeros(width, np.int64) for a, z in bounds])
    middle = (low + high) / 2
    radius = np.array([np.sqrt(((v[a:z] - m) ** 2).sum(1).max()) if z > a else 0.0 for (a, z), m in zip(bounds, middle, strict=True)])
    own = [t.column(c).to_numpy()[order].astype(np.int64).tobytes() for c in ("vec_id", "label", "copies")]
    row = [key[0].as_py(), key[1].as_py(), len(v), *own, v.tobytes(), ends.astype(np.int64).tobytes(), low.tobytes(), high.tobytes(), middle.tobytes(), radius.tobytes()]
    names = [x.split()[0] for x in BLOCKS.split(", ")]
    kinds = [pa.int32(), pa.int64(), pa.int32()] + [pa.binary()] * 9
    return pa.table([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names)


def blocks(rows: DataFrame, size: int, leaf_size: int, width: int, total: int, path: str) -> DataFrame:
    """The blocks of rows (vec_id, label, copies, v), no two alike, as a table: BLOCKS. Upper splits come from a bounded sample, drawn by a hash; all rows are dealt to blocks of about size rows."""
    levels = min(LEVELS, max(0, ceil(log2(max(1, total / size)))))
    hashed = F.xxhash64("vec_id", "label", "v")
    drawn = rows.select("v").orderBy(hashed, "v").limit(SAMPLE).toArrow().column("v").combine_chunks() if levels else pa.array([], pa.list_(pa.int64()))
    splits = Splits(vectors.matrix(drawn, width).astype(np.float64), levels)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf = splits.leaves(vectors.matrix(b.column("v"), width))
            yield b.append_column("leaf", pa.array(leaf, pa.int32()))

    schema = "vec_id long, label long, copies long, v array<long>, leaf int"
    put_down = rows.select("vec_id", "label", "copies", "v").mapInArrow(common.tidy(put), schema)
    n = {r["leaf"]: r["n"] for r in put_down.groupBy("leaf").agg(F.count("*").alias("n")).collect()}  # 2**LEVELS rows at most
    cuts = F.element_at(F.array(*[F.lit(ceil(n.get(i, 0) / size) or 1).cast("long") for i in range(1 << levels)]), F.col("leaf") + 1)
    dealt = put_down.withColumn("block", F.pmod(F.xxhash64("v", "label", "vec_id"), cuts))
    return common.written(dealt.groupBy("leaf", "block").applyInArrow(lambda key, t: _blocked(leaf_size, width, key, t), BLOCKS), path)


NODE = ("low", "high", "middle", "radius")


def products(a: dict, c: dict) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the inner products between nodes (low, high, middle: components in the last axis; radius), by their boxes and by their balls. Axes before the last are broadcast."""
    corners = [x * y for x in (a["low"], a["high"]) for y in (c["low"], c["high"])]
    least = np.minimum(np.minimum(corners[0], corners[1]), np.minimum(corners[2], corners[3])).sum(-1)
    greatest = np.maximum(np.maximum(corners[0], corners[1]), np.maximum(corners[2], corners[3])).sum(-1)
    size = lambda x: np.sqrt((x["middle"] ** 2).sum(-1))
    centre = (a["middle"] * c["middle"]).sum(-1)
    slack = size(a) * c["radius"] + a["radius"] * size(c) + a["radius"] * c["radius"]
    slack = slack + (np.abs(centre) + slack) * 1e-9 + 1  # so that rounding gives nothing up
    return np.maximum(least, centre - slack), np.minimum(greatest, centre + slack)


def exact(a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of rows; by doubles where these hold every sum exactly, which is faster."""
    largest = lambda x: int(np.abs(x).max(initial=0))
    if a.shape[1] * largest(a) * largest(c) < 1 << 53:
        return (a.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    return a @ c.T


def best(i: np.ndarray, score: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the first most entries of each i, by score from the highest on, then by id."""
    order = np.lexsort((ids, -score, i))
    own = i[order]
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, np.int64)
    nth = np.arange(len(own)) - np.repeat(first, np.diff(np.concatenate([first, [len(own)]])))
    return order[nth < most]


def compared(a: dict, c: dict, low: np.ndarray, high: np.ndarray, same: bool, most: int) -> tuple[np.ndarray, ...]:
    """(i, j, score, place in c): for window j of anchor i (products from low[i, j] to high[i, j]) the most best candidates of the anchor's label, or of others. An anchor is no candidate of itself; a copy of it is one."""
    a_at, c_at = np.concatenate([[0], a["ends"]]), np.concatenate([[0], c["ends"]])
    n, m = np.diff(a_at), np.diff(c_at)
    one = lambda x, s: {k: x[k][1:][s] for k in NODE}
    lo, up = products(one(a, np.s_[:, None]), one(c, np.s_[None]))
    least, greatest = low.min(1), high.max(1)
    found = []
    for x in np.flatnonzero(n):
        rows = slice(a_at[x], a_at[x + 1])
        alive = (up[x] >= least[rows].min()) & (lo[x] <= greatest[rows].max())
        cols = common.ragged(c_at[:-1][alive], m[alive])
        if not len(cols):
            continue
        score = exact(a["vectors"][rows], c["vectors"][cols])
        right = (a["labels"][rows, None] == c["labels"][cols]) == same
        i, k = np.nonzero(right & (score >= least[rows, None]) & (score <= greatest[rows, None]))
        found.append((i + a_at[x], score[i, k], cols[k]))
    if not found:
        return (np.zeros(0, np.int64),) * 4
    i, score, at = (np.concatenate(x) for x in zip(*found, strict=True))
    itself = (a["ids"][i] == c["ids"][at]) & (a["labels"][i] == c["labels"][at])
    itself[itself] = (a["vectors"][i[itself]] == c["vectors"][at[itself]]).all(1)
    times = np.minimum(c["copies"][at] - itself, most)
    i, score, at = (np.repeat(x, times) for x in (i, score, at))
    out = []
    for j in range(low.shape[1]):
        fits = np.flatnonzero((score >= low[i, j]) & (score <= high[i, j]))
        fits = fits[best(i[fits], score[fits], c["ids"][at[fits]], most)]
        out.append((i[fits], np.full(len(fits), j), score[fits], at[fits]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


FOUND = pa.schema([("leaf", pa.int32()), ("block", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("anchor_id", pa.int64()), ("score", pa.int64()), ("vec_id", pa.int64())])


def _block(r: dict, width: int, suffix: str = "") -> dict:
    take = lambda k, t=np.int64: np.frombuffer(r[k + suffix], t)
    out = {k: take(k) for k in ("ids", "labels", "copies", "ends")}
    return out | {k: take(k).reshape(-1, width) for k in ("vectors", "low", "high")} | {"middle": take("middle", np.float64).reshape(-1, width), "radius": take("radius", np.float64)}


def _root(b: pa.RecordBatch, width: int, suffix: str = "") -> dict:
    """The nodes around all rows of blocks, one for each row of a batch."""
    first = lambda k, t, n: np.array([np.frombuffer(x, t, n) for x in b.column(k + suffix).to_pylist()], t).reshape(b.num_rows, n)
    return {"low": first("low", np.int64, width), "high": first("high", np.int64, width), "middle": first("middle", np.float64, width), "radius": first("radius", np.float64, 1)[:, 0]}


def hulls(table: DataFrame, width: int) -> tuple[np.ndarray, dict]:
    """The leaves that have blocks, 2**LEVELS at most, and a node around each one's blocks: a bounded table. A task sends one row for each leaf."""

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, tuple] = {}
        for b in batches:
            root = _root(b, width)
            for leaf, low, high in zip(b.column("leaf").to_pylist(), root["low"], root["high"], strict=True):
                have = own.get(leaf, (low, high))
                own[leaf] = np.minimum(low, have[0]), np.maximum(high, have[1])
        kind = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.int32()), *[pa.array([x[k].tolist() for x in own.values()], kind) for k in (0, 1)]], ["leaf", "low", "high"])

    parts = table.select("leaf", *NODE).mapInArrow(common.tidy(around), "leaf int, low array<long>, high array<long>")
    ends = lambda f, c: F.array(*[f(F.col(c)[i]) for i in range(width)]).alias(c)
    rows = parts.groupBy("leaf").agg(ends(F.min, "low"), ends(F.max, "high")).orderBy("leaf").collect()
    low, high = (np.array([r[k] for r in rows], np.int64).reshape(len(rows), width) for k in ("low", "high"))
    return np.array([r["leaf"] for r in rows], np.int32), {"low": low, "high": high, "middle": (low + high) / 2, "radius": np.sqrt((((high - low) / 2) ** 2).sum(1))}


def _met(asked: DataFrame, candidates: DataFrame, around: tuple, width: int, first: bool) -> DataFrame:
    """(leaf, block, c_leaf, c_block): blocks of anchors (with their node, least and greatest wanted product) and of candidates that may have a wanted product, first the leaves, then the blocks of those left. With first only one block of the leaf that promises most, without it all others."""
    leaves, nodes_ = around
    names = ["leaf", "block", "c_leaf"]

    def by_leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in (b.slice(k, 1) for k in range(b.num_rows)):
                lo, up = products({k: v[:1] for k, v in _root(r, width).items()}, nodes_)
                promising = np.arange(len(leaves)) == up.argmax()
                ok = promising if first else (up >= r.column("least")[0].as_py()) & (lo <= r.column("greatest")[0].as_py())
                n = int(ok.sum())
                cols = [pa.array([r.column(k)[0].as_py()] * n, t) for k, t in (("leaf", pa.int32()), ("block", pa.int64()))]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(leaves[ok]), pa.array(promising[ok])], [*names, "promising"])

    asked = asked.select("leaf", "block", *NODE, "least", "greatest")
    leaf_pairs = asked.mapInArrow(common.tidy(by_leaf), "leaf int, block long, c_leaf int, promising boolean")
    if first:
        return leaf_pairs.select(*names, F.lit(0).cast("long").alias("c_block"))
    theirs = candidates.select(F.col("leaf").alias("c_leaf"), F.col("block").alias("c_block"), *[F.col(c).alias(c + "_c") for c in NODE])
    both = leaf_pairs.join(asked, ["leaf", "block"]).join(theirs, "c_leaf").where("not (promising and c_block = 0)")

    def by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lo, up = products(_root(b, width), _root(b, width, "_c"))
            ok = (up >= b.column("least").to_numpy()) & (lo <= b.column("greatest").to_numpy())
            yield b.select([*names, "c_block"]).filter(pa.array(ok))

    return both.mapInArrow(common.tidy(by_block), "leaf int, block long, c_leaf int, c_block long")


def _pass(anchors: DataFrame, candidates: DataFrame, around: tuple, windows: DataFrame | None, width: int, kind: tuple[bool, int, int], first: bool, path: str) -> DataFrame:
    """One search, as a table of FOUND: the best candidates of each window in each pair of blocks that is left. windows: (leaf, block, i, j, low, high); anchors without any take whatever there is, if kind says so by one window."""
    same, count, most = kind
    if windows is None:
        asked = anchors.withColumns({"windows": F.array().cast("array<struct<i:int,j:int,low:bigint,high:bigint>>"), "least": F.lit(-FAR), "greatest": F.lit(FAR)})
    else:
        own = windows.groupBy("leaf", "block").agg(F.collect_list(F.struct("i", "j", "low", "high")).alias("windows"))  # ANCHORS times count at most
        asked = anchors.join(own, ["leaf", "block"], "left" if same else "inner").withColumn("windows", F.coalesce("windows", F.array()))
        narrow = F.size("windows") == F.col("n") if same else F.lit(True)
        asked = asked.withColumns({"least": F.when(narrow, F.array_min(F.col("windows")["low"])).otherwise(-FAR), "greatest": F.when(narrow, F.array_max(F.col("windows")["high"])).otherwise(FAR)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                r = b.slice(k, 1).to_pylist()[0]
                a, c = _block(r, width), _block(r, width, "_c")
                shape = len(a["ids"]), count
                low, high = (np.full(shape, x) for x in ((-FAR, FAR) if same else (FAR, -FAR)))
                for w in r["windows"]:
                    low[w["i"], w["j"]], high[w["i"], w["j"]] = w["low"], w["high"]
                i, j, score, at = compared(a, c, low, high, same, most)
                cols = [np.full(len(i), r["leaf"]), np.full(len(i), r["block"]), i, j, a["ids"][i], score, c["ids"][at]]
                yield pa.RecordBatch.from_arrays([pa.array(x.astype(t.to_pandas_dtype()), t) for x, t in zip(cols, FOUND.types, strict=True)], FOUND.names)

    pairs = _met(asked, candidates, around, width, first)
    more = [x.split()[0] for x in BLOCKS.split(", ")]
    theirs = candidates.select(*[F.col(c).alias({"leaf": "c_leaf", "block": "c_block"}.get(c, c + "_c")) for c in more])
    both = pairs.join(asked.drop("least", "greatest"), ["leaf", "block"]).join(theirs, ["c_leaf", "c_block"])
    return common.written(both.mapInArrow(common.tidy(run), "leaf int, block long, i int, j int, anchor_id long, score long, vec_id long"), path)


WINDOW = ["leaf", "block", "i", "j"]


def _top(found: DataFrame, most: int) -> DataFrame:
    """found with ``rank``: the first most rows of each window, over all blocks."""
    rank = F.row_number().over(Window.partitionBy(*WINDOW).orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= most)


def _searched(anchors: DataFrame, candidates: DataFrame, around: tuple, windows: DataFrame | None, width: int, kind: tuple[bool, int, int], path: str) -> DataFrame:
    """The best of each window: one promising block first, whose results raise the windows' lower ends for all others."""
    most = kind[2]
    one = _pass(anchors, candidates, around, windows, width, kind, True, f"{path}-first")
    full = _top(one, most).groupBy(*WINDOW).agg(F.count("*").alias("k"), F.min("score").alias("worst")).where(F.col("k") == most).drop("k")
    if windows is None:
        narrowed = full.select(*WINDOW, F.col("worst").alias("low"), F.lit(FAR).alias("high"))
    else:
        narrowed = windows.join(full, WINDOW, "left").select(*WINDOW, F.greatest("low", "worst").alias("low"), "high")
    rest = _pass(anchors, candidates, around, narrowed, width, kind, False, f"{path}-rest")
    return common.written(_top(one.unionByName(rest), most), f"{path}-top")


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mined(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of rows (vec_id, label, embedding).

    An anchor's positives are the rows of its label with the highest inner
    products, ties by smaller vec_id, itself left out; the negatives of each
    positive are the rows of other labels with the highest products from low to
    high percent of the positive's. Rows without an id, a label or a whole,
    finite vector take no part. Rows that agree in all three are one anchor, and
    as candidates count each by itself. A shorter vector counts as followed by
    zeros. Anchors without a positive, and positives without a negative, give
    no row; an empty table gives an empty result; other columns are not looked
    at. A component beyond what is exact (see ``vectors.LARGEST``) is an error.
    """
    spark = rows.sparkSession
    common.ready(spark)
    folder = common.shared_folder(spark)
    given = rows.where("vec_id is not null and label is not null").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    whole = vectors.vectors(given, "vec_id", "label").groupBy("vec_id", "label", "v").agg(F.count("*").alias("copies"))
    whole = common.written(whole, f"{folder}/rows")
    asking = whole.where(is_anchor)
    width, total = whole.agg(F.max(F.size("v")), F.count("*")).first()
    n_anchors = asking.count()
    if not n_anchors or not width:
        common.removed(spark, folder)
        return spark.createDataFrame([], RESULT)
    candidates = blocks(whole, BLOCK, LEAF, width, total, f"{folder}/candidates")
    anchors = blocks(asking, ANCHORS, ANCHOR_LEAF, width, n_anchors, f"{folder}/anchors")
    around = hulls(candidates, width)
    good = _searched(anchors, candidates, around, None, width, (True, 1, positives), f"{folder}/positives")
    good = good.select("leaf", "block", "i", (F.col("rank") - 1).alias("j"), "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    share = lambda percent, f: f(F.col("positive_score") * percent / F.lit(100).cast("decimal(3,0)")).cast("long")
    windows = good.select(*WINDOW, share(low, F.ceil).alias("low"), share(high, F.floor).alias("high")).where("low <= high")
    bad = _searched(anchors, candidates, around, windows, width, (False, positives, negatives), f"{folder}/negatives")
    bad = bad.select(*WINDOW, F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    out = good.join(bad, WINDOW).select(*[x.split()[0] for x in RESULT.split(", ")])
    out = common.written(out, f"{folder}-mined")
    common.removed(spark, folder)
    return out
