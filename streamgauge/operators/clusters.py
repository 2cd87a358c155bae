"""k-means from many starts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_centers(points: DataFrame, key: str, vector: str, k: int, restarts: int, seed: int) -> np.ndarray:
    """``restarts`` times ``k`` points with the smallest hash of their key and the start's number.

    Fewer than ``k`` points give fewer centres. What reaches the driver is bounded by the parameters.
    """
    hashed = points.select(vector, F.col(key).alias("_key"), F.explode(F.sequence(F.lit(0), F.lit(restarts - 1))).alias("_start"))
    order = Window.partitionBy("_start").orderBy("_hash", "_key")
    chosen = (
        hashed.withColumn("_hash", F.xxhash64("_key", F.col("_start") + seed))
        .withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= k)
        .select("_start", "_rank", vector)
        .toArrow()
        .sort_by([("_start", "ascending"), ("_rank", "ascending")])
    )
    if chosen.num_rows == 0:
        return np.zeros((restarts, 0, 0))
    return np.array(chosen.column(vector).to_pylist(), float).reshape(restarts, chosen.num_rows // restarts, -1)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def _nearest(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each point's nearest centre; the first of equally near ones."""
    apart = (centers**2).sum(1) - 2 * x @ centers.T
    place = apart.argmin(1)
    return place, ((x - centers[place]) ** 2).sum(1)


def lloyd_step(points: DataFrame, vector: str, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centres of the points nearest to each centre, and the sum of squared distances, for every start.

    One scan. A task adds up its points and returns a row per start, centre and
    dimension, whatever it has read; Spark adds these up. A centre without points stays.
    """
    restarts, k, dims = centers.shape

    def run(batches):
        sums = np.zeros((restarts, k, dims + 2))
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = _matrix(batch.column(0))
            for start in range(restarts):
                place, far = _nearest(x, centers[start])
                member = (place == np.arange(k)[:, None]).astype(float)
                sums[start, :, 0] += member.sum(1)
                sums[start, :, 1] += member @ far
                sums[start, :, 2:] += member @ x
        if sums[:, :, 0].any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(sums.size, dtype=np.int32)), pa.array(sums.ravel())], ["place", "value"])

    found = points.select(vector).mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).toArrow()
    sums = np.zeros(centers.size + 2 * restarts * k)
    sums[found.column("place").to_numpy()] = found.column("value").to_numpy()
    sums = sums.reshape(restarts, k, dims + 2)
    n = sums[:, :, :1]
    return np.where(n > 0, sums[:, :, 2:] / np.maximum(n, 1), centers), sums[:, :, 1].sum(1)


def best_centers(points: DataFrame, key: str, vector: str, k: int, restarts: int = 20, seed: int = 42, max_iter: int = 20, tolerance: float = 1e-4) -> np.ndarray:
    """Centres of the start with the smallest sum of squared distances, after steps until no centre moves.

    A start that stands still, or a centre that moves less than ``tolerance``,
    is not followed further. ``points`` are read once per step, so they should be
    a stored table.
    """
    centers = first_centers(points, key, vector, k, restarts, seed)
    if centers.shape[1] == 0:
        return centers[0]
    cost = np.full(restarts, np.inf)
    moving = np.arange(restarts)
    for _ in range(max_iter):
        moved, cost[moving] = lloyd_step(points, vector, centers[moving])
        still = ((moved - centers[moving]) ** 2).sum(2).max(1) <= tolerance**2
        centers[moving] = moved
        moving = moving[~still]
        if not len(moving):
            break
    return centers[int(cost.argmin())]


def assign_clusters(points: DataFrame, vector: str, centers: np.ndarray, out: str) -> DataFrame:
    """``points`` with the number of the nearest centre."""

    @F.arrow_udf("int")
    def nearest(column: pa.Array) -> pa.Array:
        return pa.array(_nearest(_matrix(column), centers)[0].astype(np.int32)) if len(column) else pa.array([], pa.int32())

    return points.withColumn(out, nearest(vector))
