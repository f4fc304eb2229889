"""Centroid clustering by plain Lloyd rounds over vectors of integers.

The centroids, a bounded table, go with the tasks. Each task compares its
vectors with one centroid after the other in exact integers and adds up what
falls to each; a row of sums for each task and centroid is all that is
shuffled. As every number is whole, results do not depend on how rows are
dealt, and a task that runs again gives the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, vectors

SIZE, CENTRES, ROUNDS, SEED = 64, 40, 5, "2"


def kept(rows: DataFrame, size: int = SIZE) -> DataFrame:
    """(vec_id, v) of the rows whose ``embedding`` has exactly size components, none null or not finite."""
    return vectors.vectors(rows, "vec_id", size=size)


def first_centres(points: DataFrame, centres: int = CENTRES, seed: str = SEED) -> np.ndarray:
    """The points with the smallest SHA-256 of seed:vec_id as text (a null id is the empty text), in that order; equal ids in the order of their vectors. Fewer points give fewer centres."""
    name = F.concat(F.lit(seed + ":"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    got = points.select(F.sha2(name.cast("binary"), 256).alias("h"), "v").orderBy("h", "v").limit(centres).collect()
    return vectors.checked(np.array([r["v"] for r in got], np.int64)) if got else np.zeros((0, 0), np.int64)


def nearest(v: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each vector's nearest centre, of equally near ones the first, and the squared distance."""
    far = np.empty((len(v), len(centres)), np.int64)
    for k, c in enumerate(centres):
        away = v - c
        far[:, k] = np.einsum("ij,ij->i", away, away)
    best = far.argmin(1)
    return best, far[np.arange(len(v)), best]


def _stacked(column: pd.Series, width: int) -> np.ndarray:
    return vectors.checked(np.stack(column.to_numpy()).astype(np.int64) if len(column) else np.zeros((0, width), np.int64))


def moved(points: DataFrame, centres: np.ndarray) -> np.ndarray:
    """One round: every centre with points becomes the exact floor of their mean, component by component; the others stay."""
    k, width = centres.shape

    def sums(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, total = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for pdf in parts:
            v = _stacked(pdf["v"], width)
            best, _ = nearest(v, centres)
            n += np.bincount(best, minlength=k)
            np.add.at(total, best, v)
        some = np.flatnonzero(n)
        yield pd.DataFrame({"cluster": some, "n": n[some], "total": list(total[some])})

    each = points.select("v").mapInPandas(sums, "cluster int, n long, total array<long>")
    whole = each.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)])
    out = centres.copy()
    for r in whole.collect():  # a row for each centre at most
        out[r["cluster"]] = [int(r[f"s{i}"]) // r["n"] for i in range(width)]
    return out


def learn(points: DataFrame, centres: int = CENTRES, rounds: int = ROUNDS, seed: str = SEED) -> np.ndarray:
    """The centres of points (vec_id, v), one in a row, after so many rounds. Without points there are none."""
    common.ready(points.sparkSession)
    now = first_centres(points, centres, seed)
    for _ in range(rounds if len(now) else 0):
        now = moved(points, now)
    return now


def assigned(points: DataFrame, centres: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of points (vec_id, v): the nearest centre, ties to the first, and the squared distance. Map-only."""
    common.ready(points.sparkSession)

    def near(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            best, far = nearest(_stacked(pdf["v"], centres.shape[1]), centres)
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "cluster": best, "distance": far})

    return points.select("vec_id", "v").mapInPandas(near, "vec_id long, cluster int, distance long")


def clustered(rows: DataFrame, size: int = SIZE, centres: int = CENTRES, rounds: int = ROUNDS, seed: str = SEED) -> DataFrame:
    """One row for each kept vector: vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256.

    Rows without a vector, with another number of components, or with a null,
    infinite or NaN component give no row; repeated rows and ids count each by
    itself; a null id comes back as null; an empty table gives an empty
    result; columns besides vec_id and embedding are not looked at. A
    component beyond what is exact (see ``vectors.LARGEST``) is an error.
    """
    points = kept(rows, size)
    last = learn(points, centres, rounds, seed)
    if not len(last):
        return points.select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))])
    near = assigned(points, last)
    got = {r["cluster"]: int(r["d"]) for r in near.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    own = F.array(*[F.struct(F.lit(got.get(k, 0)).cast("long").alias("inertia"), F.lit(hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()).alias("sha")) for k, c in enumerate(last.tolist())])
    at = F.element_at(own, F.col("cluster") + 1)
    return near.select("vec_id", "cluster", "distance", at["inertia"].alias("cluster_inertia"), F.lit(sum(got.values())).cast("long").alias("inertia"), at["sha"].alias("centroid_sha256"))
