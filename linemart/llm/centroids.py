"""Centroid clustering over integer vectors by a bisector tournament.

Components are scaled and floored to integers, so every step is exact. The bisector of two centroids a < b is the plane
where both are equally far: a vector x lies on b's side if normal . x > threshold, with normal = 2 (b - a) and threshold
= |b|^2 - |a|^2. Normals and thresholds of all pairs are computed once a round. A vector then plays k - 1 such sign
tests, each between the winner so far and the next centroid; a loser is out for good, and zero favours the smaller
number, which is always the winner so far. Only the winner's distance is computed.

A round reads the vectors where they lie and shuffles sums alone: each task gives one row for each centroid it has met.
Centroids and sums (k rows) pass the driver; vectors never do.

Vectors take part if they have exactly `width` components and none is null or not finite; a null or empty vector takes
none. Rows that repeat an id count each; so do rows with a null id, which begin as centroids only after all others.
Equal hashes (repeated ids) are ordered by the vector. With fewer vectors than k there are fewer centroids; without any,
both results are empty. A centroid without vectors stays as it is. Other columns of the input, whatever their names, are
not read. Components too large for products in 64 bits are computed as whole numbers of any size; a sum or a distance
that no long can hold is an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linemart.llm.shared import stored
from linemart.llm.topk import usable

#: Whole numbers that a double holds exactly.
EXACT = 2.0**53


class Bisectors:
    """Normals and thresholds of all pairs of centroids: k * k * width numbers."""

    def __init__(self, centroids: list[list[int]]) -> None:
        self.width = len(centroids[0])
        self.limit = isqrt(2**60 // self.width)  # products and sums of numbers up to it stay within 64 bits
        self.whole = np.array(centroids, object)
        self.large = max((abs(v) for c in centroids for v in c), default=0) > self.limit
        c = self.whole if self.large else self.whole.astype(np.int64)
        square = (c * c).sum(1)
        self.centroids, self.normals, self.thresholds = c, 2 * (c[None, :, :] - c[:, None, :]), square[None, :] - square[:, None]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of the nearest centroid of each row of x, and the squared distance to it."""
        won = np.zeros(len(x), np.int64)
        for rival in range(1, len(self.centroids)):
            side = (x * self.normals[won, rival]).sum(1) - self.thresholds[won, rival]
            won[(side > 0).astype(bool)] = rival
        away = x - self.centroids[won]
        return won, (away * away).sum(1)


def whole(vectors: pa.Array | pa.ChunkedArray, width: int, scale: float, limit: int) -> np.ndarray:
    """floor(scale * x) as a matrix of whole numbers: of 64 bits if none is above the limit, else of any size."""
    flat = pa.chunked_array(vectors).combine_chunks().flatten() if isinstance(vectors, pa.ChunkedArray) else vectors.flatten()
    x = np.floor(flat.to_numpy(zero_copy_only=False).astype(np.float64) * scale).reshape(-1, width)
    if np.isinf(x).any():
        raise OverflowError("a scaled component is out of the range of a double")
    if np.abs(x).max(initial=0) <= limit:
        return x.astype(np.int64)
    return np.array([[int(v) for v in row] for row in x], object).reshape(-1, width)


def _matrix(vectors: pa.Array, sides: Bisectors, scale: float) -> np.ndarray:
    x = whole(vectors, sides.width, scale, sides.limit)
    return x.astype(object) if sides.large else x


def _sums(sides: Bisectors, scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(sides.centroids)
        n, total = [0] * k, np.zeros((k, sides.width), object)
        for batch in batches:
            x = _matrix(batch.column("x"), sides, scale)
            won, _ = sides.nearest(x)
            for c in np.unique(won).tolist():
                mine = x[won == c]
                n[c] += len(mine)
                total[c] += mine.sum(0)
        met = [c for c in range(k) if n[c]]
        if met:
            rows = {"cluster": pa.array(met, pa.int32()), "n": pa.array([n[c] for c in met], pa.int64()), "total": pa.array([list(map(int, total[c])) for c in met], pa.list_(pa.int64()))}
            yield pa.RecordBatch.from_pydict(rows)

    return run


def _assigned(sides: Bisectors, scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            won, distance = sides.nearest(_matrix(batch.column("x"), sides, scale))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(won.astype(np.int32)), pa.array(distance.tolist(), pa.int64())], ["id", "cluster", "distance"])

    return run


def moved(rows: DataFrame, centroids: list[list[int]], scale: float) -> list[list[int]]:
    """The centroids after a round: the floors of the means of their vectors, or themselves if they have none."""
    met = rows.select("x").mapInArrow(_sums(Bisectors(centroids), scale), "cluster int, n long, total array<long>")
    each = met.select("cluster", "n", F.posexplode("total").alias("at", "v")).groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    out = [list(c) for c in centroids]
    for r in each.collect():  # k * width rows
        out[r["cluster"]][r["at"]] = r["v"] // r["n"]
    return out


def cluster(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 16, rounds: int = 3, width: int = 64, scale: float = 64.0, seed: str = "1",
) -> tuple[DataFrame, DataFrame]:
    """(id, cluster, distance) of each vector, and (cluster, centroid, n, inertia) of each centroid.

    The first centroids are the k vectors with the smallest SHA-256 of `seed:id`. After the rounds every vector is
    assigned once more.
    """
    spark = vectors.sparkSession
    rows = vectors.filter(usable(F.col(vec_col)) & (F.size(vec_col) == width)).select(F.col(id_col).alias("id"), F.col(vec_col).alias("x"))
    kind = rows.schema["id"].dataType
    first = rows.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).asc_nulls_last(), "x").limit(k).collect()
    result = T.StructType([T.StructField("id", kind), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    if first:
        x = whole(pa.array([list(map(float, r["x"])) for r in first], pa.list_(pa.float64())), width, scale, -1)
        centroids = [[int(v) for v in row] for row in x]
        for _ in range(rounds):
            centroids = moved(rows, centroids, scale)
        assigned = stored(rows.mapInArrow(_assigned(Bisectors(centroids), scale), result))
    else:
        centroids, assigned = [], spark.createDataFrame([], result)
    sums = {r["cluster"]: (r["n"], r["inertia"]) for r in assigned.groupBy("cluster").agg(F.count("*").alias("n"), F.sum("distance").alias("inertia")).collect()}
    named = [(c, v, *sums.get(c, (0, 0))) for c, v in enumerate(centroids)]
    return assigned.withColumnRenamed("id", id_col), spark.createDataFrame(named, "cluster int, centroid array<long>, n long, inertia long")
