"""Sequences against each other: by rank, by position, by edit distance."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The largest deviation of a pair, what a gap costs, and the range in which a fitted scale is believed.
FARTHEST, GAP, SCALES = 16.0, 22.0, (0.9, 1.1)
#: Cells of a matrix that a matcher holds at once, and differences that a vote looks at together; longer pages are done in parts, with the same result.
CELLS = 1 << 20


def by_rank(left: DataFrame, right: DataFrame, keys: list[str], value: str = "text", missing: str = "<missing>") -> DataFrame:
    """(keys, expected, obtained, same): a full outer join on the rank in keys, with a mark where one side is shorter."""
    both = left.select(*keys, F.col(value).alias("expected")).join(right.select(*keys, F.col(value).alias("obtained")), keys, "full")
    both = both.withColumns({c: F.coalesce(c, F.lit(missing)) for c in ("expected", "obtained")})
    return both.withColumn("same", F.col("expected") == F.col("obtained"))


def first_difference(compared: DataFrame, by: list[str], rank: str) -> DataFrame:
    return compared.groupBy(*by).agg(F.count_if(~F.col("same")).alias("differences"), F.min(F.when(~F.col("same"), F.struct(rank, "expected", "obtained"))).alias("first"))


def rejoined(expected: DataFrame, obtained: DataFrame, by: list[str], rank: str = "rank", value: str = "text", splits: Column | None = None) -> DataFrame:
    """obtained (by, rank, value) with the pieces of split lines put together again: (by, rank, value, pieces), ranks counted from 1.

    Both sides are walked together. As long as what is there of a line is a
    beginning of the expected line at its place, but not all of it, and another
    piece follows, that piece is added; so a line that was not split, or is
    another one, is as it was. splits says which expected lines may have been
    split, all by default. A page at a time, as one fold over its pieces; pages
    without an expected line stay as they are.
    """
    ok = F.lit(True) if splits is None else F.coalesce(splits, F.lit(False))
    want = expected.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(rank, F.col(value).alias("t"), ok.alias("ok")))).alias("_want"))
    have = obtained.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(rank, F.col(value).alias("t"))))["t"].alias("_have"))
    done = "array<struct<t:string,n:int>>"
    begin = F.struct(F.lit(None).cast("string").alias("open"), F.lit(0).alias("n"), F.array().cast(done).alias("out"))

    def step(acc: Column, piece: Column) -> Column:
        now, n = F.concat(F.coalesce(acc["open"], F.lit("")), F.coalesce(piece, F.lit(""))), acc["n"] + 1
        line = F.get("_want", F.size(acc["out"]))
        part = F.coalesce(line["ok"] & (line["t"] != now) & F.startswith(line["t"], now), F.lit(False))
        whole = F.concat(acc["out"], F.array(F.struct(now.alias("t"), n.alias("n"))))
        return F.struct(F.when(part, now).alias("open"), F.when(part, n).otherwise(0).alias("n"), F.when(part, acc["out"]).otherwise(whole).alias("out"))

    def end(acc: Column) -> Column:
        last = F.array(F.struct(acc["open"].alias("t"), acc["n"].alias("n")))
        return F.when(acc["n"] > 0, F.concat(acc["out"], last)).otherwise(acc["out"])

    d = have.join(want, by, "left").withColumn("_want", F.coalesce("_want", F.array().cast(want.schema["_want"].dataType)))
    d = d.select(*by, F.posexplode(F.aggregate("_have", begin, step, end)).alias("_i", "_x"))
    return d.select(*by, (F.col("_i") + 1).cast("long").alias(rank), F.col("_x.t").alias(value), F.col("_x.n").cast("long").alias("pieces"))


def counts_agree(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """(by) where both sides have as many rows: only there do ranks mean the same."""
    a, b = left.groupBy(*by).agg(F.count("*").alias("_a")), right.groupBy(*by).agg(F.count("*").alias("_b"))
    return a.join(b, by).where("_a = _b").select(*by)


def zipped(rows: DataFrame, keys: list[str], left: str, right: str) -> DataFrame:
    """(keys, rank, left, right): two arrays position by position, where they are as long as each other."""
    d = rows.where(F.size(left) == F.size(right)).select(*keys, F.posexplode(F.arrays_zip(left, right)).alias("rank", "x"))
    return d.select(*keys, (F.col("rank") + 1).cast("long").alias("rank"), F.col(f"x.{left}").alias(left), F.col(f"x.{right}").alias(right))


def _line(u: np.ndarray, v: np.ndarray) -> tuple[float, float]:
    """Scale and offset of the least squares line of v over u; a scale outside SCALES counts as 1."""
    away = u - u.mean()
    scale = float(away @ v / (away @ away))
    scale = scale if SCALES[0] < scale < SCALES[1] else 1.0
    return scale, float(v.mean() - scale * u.mean())


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 8) -> tuple[float, float]:
    """Scale and offset that lay the points x over y: from both ranges laid over each other on, the line through each point's nearest neighbour, until the neighbours stay the same. Neighbours farther than three gaps do not count."""
    s = np.sort(y)
    if min(len(x), len(s)) < 2 or not np.ptp(x):
        return 1.0, float(s.mean() - x.mean()) if len(x) and len(s) else 0.0
    scale = np.ptp(s) / np.ptp(x)
    offset, before = s[0] - scale * x.min(), None
    for _ in range(rounds):
        at = scale * x + offset
        upper = np.clip(np.searchsorted(s, at), 1, len(s) - 1)
        near = upper - (at - s[upper - 1] <= s[upper] - at)
        near = np.where(np.abs(s[near] - at) < 3 * GAP, near, -1)
        use = near >= 0
        if use.sum() < 3 or not np.ptp(x[use]) or np.array_equal(near, before):
            break
        scale, offset = _line(x[use], s[near[use]])
        before = near
    return float(scale), float(offset)


def _cheapest(x: np.ndarray, y: np.ndarray, price: Callable[[np.ndarray], np.ndarray], farthest: float, gap: float, cells: int, pair_first: bool) -> list[tuple[int, int]]:
    """Pairs of the cheapest order-preserving match: a pair costs the price of its deviation, which is farthest at most, a point left alone costs gap. Of equally cheap ways back from the end a pair is taken first or, without pair_first, last, and a point of x is left alone rather than one of y.

    More than cells of the cost matrix are not held: the points of x are halved,
    the lower half is traced back first and says where the upper one ends. That
    takes a row for each halving, and the pairs are those of the whole matrix.
    """

    def priced(i: int, m: int) -> np.ndarray:
        d = np.abs(x[i] - y[:m])
        return np.where(d > farthest, np.inf, price(d))

    def below(row: np.ndarray, i: int) -> np.ndarray:  # pairs and gaps in x at once, then gaps in y as a running minimum
        steps = gap * np.arange(len(row))
        best = np.minimum(row[:-1] + priced(i, len(row) - 1), row[1:] + gap)
        return np.minimum.accumulate(np.concatenate([[row[0] + gap], best]) - steps) + steps

    out = []

    def back(row: np.ndarray, lo: int, hi: int, j: int) -> int:
        """Trace back from (hi, j) to lo, row being the costs at lo; gives the place there."""
        row = row[: j + 1]
        if hi - lo > 1 and (hi - lo + 1) * (j + 1) > cells:
            mid, half = (lo + hi) // 2, row
            for i in range(lo, mid):
                half = below(half, i)
            return back(row, lo, mid, back(half, mid, hi, j))
        cost = [row]
        for i in range(lo, hi):
            cost.append(below(cost[-1], i))
        i = hi
        while i > lo and j:
            up, d = cost[i - lo - 1], np.abs(x[i - 1] - y[j - 1])
            pair = up[j - 1] + price(d) if d <= farthest else np.inf
            alone, left = up[j] + gap, cost[i - lo][j - 1] + gap
            least = min(pair, alone, left) + 1e-6
            if pair <= least and (pair_first or (alone > least and left > least)):
                i, j = i - 1, j - 1
                out.append((i, j))
            elif alone <= least:
                i -= 1
            else:
                j -= 1
        return j

    back(gap * np.arange(len(y) + 1), 0, len(x), len(y))
    return out[::-1]


def matched(x: np.ndarray, y: np.ndarray, farthest: float = FARTHEST, gap: float = GAP, cells: int = CELLS) -> list[tuple[int, int]]:
    """Pairs (index in x, index in y) of the cheapest order-preserving match: a pair costs its deviation after fit(), at most farthest; each point left alone costs gap."""
    if not len(x) or not len(y):
        return []
    scale, offset = fit(x, y)
    return _cheapest(scale * x + offset, y, lambda d: d, farthest, gap, cells, True)


def voted(x: np.ndarray, y: np.ndarray, reach: float, cells: int = CELLS) -> float:
    """Of all differences y - x the offset that brings most x within reach of some y, the smallest of equals.

    What is within reach of y is a union of intervals; each x has them moved by
    itself, and the votes of an offset are the intervals that have begun at it
    less those that have ended before. That is a sweep over sorted ends, in
    ranges of offsets with about cells differences each.
    """
    y = np.unique(y)
    new = np.flatnonzero(np.diff(y) > 2 * reach) + 1
    begins, ends = y[np.concatenate([[0], new])] - reach, y[np.concatenate([new - 1, [len(y) - 1]])] + reach

    def upto(points: np.ndarray, o: float, side: str = "right") -> np.ndarray:
        return np.searchsorted(points, x + o, side)

    def inside(points: np.ndarray, lo: float, hi: float) -> np.ndarray:
        """The sorted differences of points and x in (lo, hi]."""
        a, n = upto(points, lo), upto(points, hi)
        n = n - a
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a, n)
        return np.sort(points[at] - np.repeat(x, n))

    best, most = 0.0, -1
    ranges = [(float(y[0] - x.max()) - 1.0, float(y[-1] - x.min()))]
    while ranges:
        lo, hi = ranges.pop()
        mid = lo + (hi - lo) / 2
        if (upto(y, hi) - upto(y, lo)).sum() > cells and hi - lo > 1e-6 * max(1.0, abs(lo), abs(hi)):
            ranges += [(mid, hi), (lo, mid)]  # the lower one is next
            continue
        offsets = np.unique(inside(y, lo, hi))
        if len(offsets):
            votes = upto(begins, lo).sum() + np.searchsorted(inside(begins, lo, hi), offsets, "right") - upto(ends, lo).sum() - np.searchsorted(inside(ends, lo, hi), offsets, "left")
            k = int(votes.argmax())
            if votes[k] > most:
                best, most = float(offsets[k]), int(votes[k])
    return best


def scored(x: np.ndarray, y: np.ndarray, reward: float = 10.0, gap: float = -1.0, cells: int = CELLS) -> list[tuple[int, int]]:
    """Pairs of the order-preserving match with the highest score: reward less the deviation, which is reward at most, for a pair, gap for a point left alone. Deviations are after the offset that brings most points within reward of another; both take memory in proportion to the points and cells."""
    if not len(x) or not len(y):
        return []
    return _cheapest(x + voted(x, y, reward, cells), y, lambda d: d - reward, reward, -gap, cells, False)


#: Rows of matched pages that go to the JVM at once.
BATCH = 1 << 16


def aligned(rows: DataFrame, by: str = "page", match: Callable[[np.ndarray, np.ndarray], list[tuple[int, int]]] = matched) -> DataFrame:
    """rows (by, side 'a' or 'b', ix, y) to (by, a, b): pairs by the matcher, and with a null the points left alone. A page is one row with both its sides, in the memory of its points and CELLS cells; pages go to the matcher in batches."""

    def points(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ix, y = (column.values.field(f).to_numpy(zero_copy_only=False) for f in ("ix", "y"))
        return column.offsets.to_numpy(), ix, y.astype(float)

    def one(ax: np.ndarray, xs: np.ndarray, bx: np.ndarray, ys: np.ndarray) -> tuple[list, list]:
        pairs = match(xs, ys)
        rest_a, rest_b = np.ones(len(xs), bool), np.ones(len(ys), bool)
        i, j = [p[0] for p in pairs], [p[1] for p in pairs]
        rest_a[i], rest_b[j] = False, False
        alone_a, alone_b = ax[rest_a].tolist(), bx[rest_b].tolist()
        return [*ax[i].tolist(), *alone_a, *[None] * len(alone_b)], [*bx[j].tolist(), *[None] * len(alone_a), *alone_b]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = pa.schema([(by, pa.int64()), ("a", pa.int64()), ("b", pa.int64())])
        for batch in batches:
            (ao, ax, xs), (bo, bx, ys) = points(batch.column(1)), points(batch.column(2))
            out: tuple[list, list, list] = ([], [], [])
            for k, key in enumerate(batch.column(0).to_pylist()):
                a, b = slice(ao[k], ao[k + 1]), slice(bo[k], bo[k + 1])
                left, right = one(ax[a], xs[a], bx[b], ys[b])
                for column, more in zip(out, ([key] * len(left), left, right), strict=True):
                    column.extend(more)
                if len(out[0]) >= BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], schema=types)
                    out = ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], schema=types)

    point = F.struct(F.col("ix").cast("long").alias("ix"), F.col("y").cast("double").alias("y"))
    sides = [F.sort_array(F.collect_list(F.when(F.col("side") == s, point))).alias(s) for s in "ab"]
    pages = rows.groupBy(F.col(by).cast("long").alias(by)).agg(*sides)
    return pages.mapInArrow(run, f"{by} long, a long, b long")


#: Texts up to so many letters are compared by the whole matrix, up to so many by vectors of bits at once.
SHORT, LONG = 256, 1024


def bit_distance(a: str, b: str) -> int:
    """The edit distance of two texts by Myers' vectors of bits: one column of the matrix is two whole numbers of len(a) bits, so a character of b takes about fifteen operations on them."""
    if a == b or not a or not b:
        return 0 if a == b else len(a) or len(b)
    codes = np.frombuffer(a.encode("utf-32-le"), "<u4")
    at = {chr(c): int.from_bytes(np.packbits(codes == c, bitorder="little").tobytes(), "little") for c in np.unique(codes)}
    top, every = len(a) - 1, (1 << len(a)) - 1
    up, down, out = every, 0, len(a)  # where a column rises and falls by one
    for c in b:
        same = at.get(c, 0)
        v = same | down
        h = (((same & up) + up) ^ up) | same
        rise, fall = down | (every & ~(h | up)), up & h
        out += (rise >> top & 1) - (fall >> top & 1)
        rise = rise << 1 | 1
        up, down = every & (fall << 1 | ~(v | rise)), every & rise & v
    return out


def near_distance(a: str, b: str, most: int) -> int | None:
    """The edit distance if it is ``most`` at most: with 0, 1, 2, ... edits, how far into a each diagonal of the matrix gets; that is steps in proportion to the length and the square of the distance."""
    x, y = (np.frombuffer(s.encode("utf-32-le") + end, "<u4") for s, end in ((a, b"\xff\xff\xff\x7f"), (b, b"\xff\xff\xff\x6f")))  # two ends that no letter equals
    n, m = len(a), len(b)

    def along(i: int, j: int) -> int:
        """How many letters agree from i and j on."""
        at, step = 0, 64
        while True:
            u, v = x[i + at : i + at + step], y[j + at : j + at + step]
            k = min(len(u), len(v))
            differ = u[:k] != v[:k]
            first = int(differ.argmax())
            if differ[first]:
                return at + first
            at, step = at + k, 2 * step

    far = np.array([along(0, 0)])  # by diagonal, which is the place in b less that in a, from -edits to edits
    for edits in range(most + 1):
        if abs(m - n) <= edits and far[m - n + edits] >= n:
            return edits
        wide = np.full(len(far) + 4, -2)
        wide[2:-2] = far
        k = np.arange(-edits - 1, edits + 2)
        far = np.maximum(np.maximum(wide[1:-1], wide[2:]) + 1, wide[:-2])
        far = np.minimum(far, np.minimum(n, m - k))
        at = np.flatnonzero((far >= 0) & (far + k >= 0))
        for _ in range(3):
            at = at[x[far[at]] == y[far[at] + k[at]]]
            far[at] += 1
        for d in at.tolist():
            far[d] += along(int(far[d]), int(far[d] + k[d]))
    return None


def _edit_distance(a: str, b: str) -> int:
    size = max(len(a), len(b))
    near = near_distance(a, b, size // 16) if size > LONG else None
    return bit_distance(a, b) if near is None else near


def _long_distance(a: Column, b: Column) -> Column:
    def over(a, b):
        return pd.Series([None if x is None or y is None else _edit_distance(x, y) for x, y in zip(a, b, strict=True)], dtype="Int64")

    over.__annotations__ = {"a": pd.Series, "b": pd.Series, "return": pd.Series}  # as objects: names would be looked up here
    return F.pandas_udf(over, "long")(a, b)


def distance(a: Column, b: Column, short: int = SHORT) -> Column:
    """The edit distance of two texts: of ``short`` ones by the whole matrix, of others by vectors of bits, of those longer than LONG by as many edits as there are, if these are few. The time of long texts that are alike follows their length and the square of their distance."""
    far = F.greatest(F.length(a), F.length(b)) > short
    return F.when(far, _long_distance(F.when(far, a), F.when(far, b))).otherwise(F.levenshtein(a, b))


def error_rate(pairs: DataFrame, by: list[str], read: Column, truth: Column) -> DataFrame:
    """(by, distance, size, rate) for each by and, with nulls, over all: edit distances over the truth's characters; what was not read costs its whole length."""
    d = F.when(read.isNull(), F.length(truth)).otherwise(distance(read, truth))
    g = pairs.select(*by, d.cast("long").alias("_d"), F.length(truth).cast("long").alias("_n"))
    out = g.groupingSets([[F.col(b) for b in by], []], *[F.col(b) for b in by]).agg(F.sum("_d").alias("distance"), F.sum("_n").alias("size"))
    return out.withColumn("rate", F.round(F.col("distance") / F.greatest("size", F.lit(1)), 6))
