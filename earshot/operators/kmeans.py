"""K-means from several starts at once.

All starts share the passes: a task compares its points with the centres of every start that
is still moving and adds up, for each centre, its points, their number and their squared
distances. These sums, starts x clusters rows, are all that is shuffled and all that
reaches the driver.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.operators.factors import few_tasks

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Clusters:
    """Centres (k x dimensions) of the cheapest start, and the cost each start ended with."""

    centres: np.ndarray
    costs: tuple[float, ...]
    passes: int

    def assign(self, points: DataFrame, doc: str, vector: str, out: str = "topic") -> DataFrame:
        """(doc, out): the nearest centre of every point, the first one on ties."""
        centres, kind = self.centres, points.schema[doc].dataType.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                nearest = distances(dense(batch.column(1)), centres).argmin(1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nearest)], names=[doc, out])

        vectors = F.col(vector).cast("array<double>").alias(vector)
        return points.select(doc, vectors).mapInArrow(run, f"`{doc}` {kind}, `{out}` int")


def dense(vectors: pa.Array) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances (points x centres), none below zero."""
    cross = points @ centres.T
    squares = (points**2).sum(1)[:, None] - 2.0 * cross + (centres**2).sum(1)
    return np.maximum(squares, 0.0)


def spread_centres(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Starting centres from a sample, each drawn with a chance in proportion to its squared
    distance from those before it (Arthur, Vassilvitskii 2007)."""
    rng = np.random.default_rng(seed)
    chosen = [int(rng.integers(len(sample)))]
    for _ in range(1, k):
        far = distances(sample, sample[chosen]).min(1)
        total = far.sum()
        chosen.append(int(rng.choice(len(sample), p=far / total)) if total > 0 else int(rng.integers(len(sample))))
    return sample[chosen].copy()


def fit(
    points: DataFrame, vector: str, k: int, seeds: tuple[int, ...], max_iter: int = 100, tol: float = 1e-4,
    sample: int = 4096, start: np.ndarray | None = None,
) -> Clusters:
    """Lloyd's rounds for all ``seeds`` together, until no centre moves by more than ``tol``.

    Starting centres are drawn from the ``sample`` points of smallest hash, a bound of the start only:
    every round and every cost covers all points. A centre without points stays where it is.
    A start whose centres have come to rest takes no part in later passes. ``start`` gives the centres (k x
    dimensions) to begin with instead.
    """
    vectors = points.select(F.col(vector).cast("array<double>").alias("v"))
    if start is not None:
        centres = np.stack([np.asarray(start, float) for _ in seeds])
    else:
        drawn = vectors.orderBy(F.xxhash64("v"), "v").limit(sample).collect()
        if not drawn:
            return Clusters(np.zeros((k, 1)), tuple(0.0 for _ in seeds), 0)
        centres = np.stack([spread_centres(np.array([r[0] for r in drawn]), k, seed) for seed in seeds])
    costs, moving, passes = np.full(len(seeds), np.inf), list(range(len(seeds))), 0
    width = centres.shape[2]
    while moving:
        fixed = centres[moving]

        def sums(batches: Iterator[pa.RecordBatch], fixed: np.ndarray = fixed) -> Iterator[pa.RecordBatch]:
            total = np.zeros((*fixed.shape[:2], width + 2))  # then the number and the cost of a centre's points
            for batch in batches:
                data = dense(batch.column(0))
                for s, now in enumerate(fixed):
                    far = distances(data, now)
                    nearest = far.argmin(1)
                    inside = np.zeros((len(data), len(now)))
                    inside[np.arange(len(data)), nearest] = 1.0
                    total[s, :, :width] += inside.T @ data
                    total[s, :, width] += inside.sum(0)
                    total[s, :, width + 1] += (inside * far).sum(0)
            rows = total.reshape(-1, width + 2)
            used = np.flatnonzero(rows[:, width])
            place = np.tile(np.arange(width + 2, dtype=np.int32), len(used))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(used, width + 2)), pa.array(place), pa.array(rows[used].ravel())],
                names=["centre", "place", "total"],
            )

        added = few_tasks(vectors).mapInArrow(sums, "centre long, place int, total double")
        merged = np.zeros((len(moving) * k, width + 2))
        for centre, place, total in added.groupBy("centre", "place").agg(F.sum("total")).collect():
            merged[centre, place] = total
        merged = merged.reshape(len(moving), k, width + 2)
        count = merged[..., width : width + 1]
        moved = np.where(count > 0, merged[..., :width] / np.maximum(count, 1), fixed)
        costs[moving] = merged[..., width + 1].sum(1)
        passes += 1
        rest = ((moved - fixed) ** 2).sum(2).max(1) <= tol * tol
        if passes < max_iter:
            centres[moving] = np.where(rest[:, None, None], fixed, moved)  # the cost belongs to these centres
            moving = [s for s, done in zip(moving, rest, strict=True) if not done]
        else:
            moving = []
    best = int(costs.argmin())
    return Clusters(centres[best], tuple(map(float, costs)), passes)
