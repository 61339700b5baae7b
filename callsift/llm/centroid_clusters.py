"""Clustering around centroids in whole numbers, by a tournament of bisectors.

For each pair of centroids i < j there is a bisector: with the normal
2 (c_j - c_i) and the threshold |c_j|^2 - |c_i|^2, a vector x is at least as
near to c_i if x . normal - threshold <= 0.  That is one linear test in whole
numbers, and zero favours the smaller number.  A vector takes k - 1 such tests,
in a tournament whose matches set a smaller number against a greater one, to
find its nearest centroid; only the distance to the winner is computed.

A round is one pass over the vectors: every task adds up its own vectors by
cluster, and k rows of sums for each task are aggregated.  Nothing but the
centroids is on the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsift.session import stage

#: Components from here on (after scaling) are refused: squared distances have to fit 63 bits.
LIMIT = 1 << 26


@dataclass(frozen=True)
class Settings:
    """``scale``: a component x becomes floor(scale * x).  ``seed``: goes into the hash that picks the first centroids."""

    clusters: int = 40
    width: int = 64
    scale: int = 256
    rounds: int = 5
    seed: int = 2


def whole_numbers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component; null if the vector is null or has a component that is null or not finite."""
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    finite = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    small = F.forall(vector, lambda x: F.abs(x.cast("double") * F.lit(float(scale))) < LIMIT)
    refused = F.raise_error(F.lit(f"a component beyond {LIMIT} / {scale} in size")).cast("array<int>")
    return F.when(F.coalesce(finite, F.lit(False)), F.when(small, scaled.cast("array<int>")).otherwise(refused))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """An Arrow list column of rows of one width."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


class Tournament:
    """Nearest centroids by sign tests against the bisectors of all pairs."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        squares = (centroids * centroids).sum(axis=1)
        self.normals = 2 * (centroids[None, :, :] - centroids[:, None, :])
        self.thresholds = squares[None, :] - squares[:, None]

    def winners(self, x: np.ndarray) -> np.ndarray:
        """The nearest centroid of each row; of several at one distance, that of the least number."""
        left = [np.full(len(x), i) for i in range(len(self.centroids))]
        while len(left) > 1:
            # neighbours meet, so the first of two always comes from smaller numbers
            won = [self._match(x, a, b) for a, b in zip(left[::2], left[1::2])]
            left = won + left[len(left) & ~1 :]
        return left[0]

    def _match(self, x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        side = np.einsum("ij,ij->i", x, self.normals[a, b]) - self.thresholds[a, b]
        return np.where(side <= 0, a, b)

    def distances(self, x: np.ndarray, won: np.ndarray) -> np.ndarray:
        apart = x - self.centroids[won]
        return np.einsum("ij,ij->i", apart, apart)


def add_up(x: np.ndarray, groups: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Count and sum of the rows of each of ``number`` groups."""
    counts, sums = np.bincount(groups, minlength=number), np.zeros((number, x.shape[1]), np.int64)
    some = counts > 0
    if some.any():
        starts = (np.cumsum(counts) - counts)[some]
        sums[some] = np.add.reduceat(x[np.argsort(groups, kind="stable")], starts, axis=0)
    return counts, sums


def pieces(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floors of means, those without a vector as before."""
    k, width = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        game = Tournament(centroids)
        counts, sums = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for part in pieces(batches, 2000):
            x = matrix(part.column("_x"), width)
            n, s = add_up(x, game.winners(x), k)
            counts, sums = counts + n, sums + s
        used = np.flatnonzero(counts)
        columns = [pa.array(used.astype(np.int32)), pa.array(counts[used])]
        columns += [pa.array(sums[used, i]) for i in range(width)]
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "n", *names])

    names = [f"x{i}" for i in range(width)]
    added = rows.select("_x").mapInArrow(run, "cluster int, n long, " + ", ".join(f"{c} long" for c in names))
    totals = added.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in names])
    after = centroids.copy()
    for row in totals.collect():  # a row for each cluster at most
        after[row["cluster"]] = [row[c] // row["n"] for c in names]
    return after


def digest(numbers: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, numbers.ravel().tolist())).encode()).hexdigest()


def first_centroids(rows: DataFrame, settings: Settings) -> np.ndarray:
    """The vectors whose keys have the least hashes; of one key, the vectors in their order."""
    named = F.concat(F.lit(f"{settings.seed}:"), F.coalesce(F.col("_key").cast("string"), F.lit("")))
    first = rows.orderBy(F.sha2(named.cast("binary"), 256), "_x").limit(settings.clusters).select("_x").collect()
    return np.array([r["_x"] for r in first], np.int64).reshape(-1, settings.width)


def cluster(df: DataFrame, key: str, vector: str, settings: Settings = Settings()) -> DataFrame:
    """key, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` of every vector that is kept.

    Kept are vectors of the stated width whose components are all finite; null
    and other vectors have no row.  Every row counts, also where keys or
    vectors repeat; a null key is hashed as an empty one.  With fewer vectors
    than clusters each of them starts a cluster; equal centroids are never
    merged, the smaller number takes the vectors.  An empty table gives an
    empty one.  Components of 2^26 or more after scaling stop the job, as
    their distances would not fit a long.
    """
    numbers = whole_numbers(F.when(F.size(vector) == settings.width, F.col(vector)), settings.scale)
    rows = stage(df.select(F.col(key).alias("_key"), numbers.alias("_x")).filter("_x is not null"))
    centroids = first_centroids(rows, settings)
    for _ in range(settings.rounds if len(centroids) else 0):
        centroids = _moved(rows, centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        game = Tournament(centroids)
        for part in pieces(batches, 2000):
            x = matrix(part.column("_x"), settings.width)
            won = game.winners(x)
            columns = [part.column("_key"), pa.array(won.astype(np.int32)), pa.array(game.distances(x, won))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    schema = T.StructType([T.StructField("_key", rows.schema["_key"].dataType), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    placed = stage(rows.mapInArrow(run, schema))
    within = {r["cluster"]: r["d"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    about = [(c, d, sum(within.values()), digest(centroids[c])) for c, d in sorted(within.items())]
    # a row for each cluster
    clusters = df.sparkSession.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    joined = placed.join(F.broadcast(clusters), "cluster")
    return joined.select(F.col("_key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
