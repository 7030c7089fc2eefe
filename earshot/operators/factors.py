"""Low-rank factors of a (document x term) table that never leaves the executors.

Both factorisations alternate between two kinds of work:

* per document, on the executors: project or solve against a small matrix of
  shape (terms x rank) that is shipped with the task;
* per term, on the driver: update that small matrix from sums over all
  documents. The sums are formed by a grouped aggregation over term ids, so the
  driver receives at most ``terms`` rows of ``rank`` numbers per round.

Nothing is carried from round to round but the small matrix. There is no growing
lineage to cut, and a lost executor costs one recomputed partition.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Executors need not have this package installed: the helpers below travel with
# the tasks that use them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


#: Columns up to which a product goes column by column; wider ones read whole rows of the dense side.
NARROW = 16


def add_products(to: np.ndarray, of: np.ndarray, val: np.ndarray, dense: np.ndarray, into: np.ndarray) -> None:
    """into[t] += the sum of val * dense[of] over the cells of each t; ``to`` is in ascending order."""
    dense = np.ascontiguousarray(dense)
    borders = np.flatnonzero(np.diff(to, prepend=-1, append=-1)).tolist()
    for a, b in zip(borders, borders[1:]):
        into[to[a]] += val[a:b] @ dense[of[a:b]]


@dataclass(frozen=True)
class Cells:
    """A batch of sparse rows as flat arrays."""

    row: np.ndarray
    idx: np.ndarray
    val: np.ndarray
    n: int
    extra: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def of(cls, batch: pa.RecordBatch, extra: tuple[str, ...] = ()) -> Cells:
        idx, val = batch.column("idx"), batch.column("val")
        lengths = np.diff(idx.offsets.to_numpy())
        return cls(
            np.repeat(np.arange(len(lengths)), lengths),
            idx.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
            val.flatten().to_numpy(zero_copy_only=False).astype(np.float64),
            len(lengths),
            {name: batch.column(name).to_numpy(zero_copy_only=False) for name in extra},
        )

    def times(self, small: np.ndarray) -> np.ndarray:
        """rows @ small: a wide one row by row, a narrow one column by column, in O(cells) memory."""
        if small.shape[1] > NARROW:
            out = np.zeros((self.n, small.shape[1]))
            add_products(self.row, self.idx, self.val, small, out)
            return out
        out = np.empty((self.n, small.shape[1]))
        for j in range(small.shape[1]):
            out[:, j] = np.bincount(self.row, self.val * small[self.idx, j], minlength=self.n)
        return out

    def add_transposed(self, dense: np.ndarray, into: np.ndarray) -> None:
        """into += rows.T @ dense."""
        if dense.shape[1] > NARROW:
            kind = np.uint16 if len(into) <= 1 << 16 else np.int64  # short numbers are sorted by digits
            order = np.argsort(self.idx.astype(kind), kind="stable")
            add_products(self.idx[order], self.row[order], self.val[order], dense, into)
            return
        for j in range(dense.shape[1]):
            into[:, j] += np.bincount(self.idx, self.val * dense[self.row, j], minlength=len(into))


def _batch(key: str, keys: pa.Array, name: str, dense: np.ndarray) -> pa.RecordBatch:
    """Keys and the rows of a dense matrix as an Arrow batch."""
    offsets = np.arange(len(dense) + 1, dtype=np.int32) * dense.shape[1]
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(dense).ravel()))
    return pa.RecordBatch.from_arrays([keys, lists], names=[key, name])


#: Columns that are summed in one row; wider ranks are cut into blocks, which
#: keeps the aggregation within generated code.
BLOCK = 32

#: Per batch: adds its share to a (terms x rank) and a (rank x rank) sum.
Contribution = Callable[[Cells, np.ndarray, np.ndarray], None]


def few_tasks(rows: DataFrame, per_core: int = 2) -> DataFrame:
    """The rows in at most ``per_core`` tasks for each core of the cluster, without moving any.

    For tasks that each send on a block of sums: what they send then follows the cluster and
    not the number of files.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.coalesce(max(1, per_core * cores))


def summed(
    rows: DataFrame, n_terms: int, rank: int, add: Contribution, extra: tuple[str, ...] = ()
) -> tuple[np.ndarray, np.ndarray]:
    """Sums of per-document contributions: (terms x rank) and (rank x rank).

    Each task adds up its own rows first and emits only the terms it saw; there are as many tasks as the
    cluster has work for, however many partitions the rows have. Spark merges by term id,
    again map-side first. Square rows have negative ids. ``extra`` columns of
    numbers come along in ``Cells.extra``.
    """

    width = min(rank, BLOCK)
    blocks = -(-rank // width)
    names = [f"c{j}" for j in range(width)]

    def partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_term, square = np.zeros((n_terms, rank)), np.zeros((rank, rank))
        for batch in batches:
            add(Cells.of(batch, extra), by_term, square)
        seen = np.flatnonzero(by_term.any(axis=1))
        keys = np.concatenate([seen, -1 - np.arange(rank)])
        values = np.concatenate([by_term[seen], square])
        values = np.pad(values, ((0, 0), (0, blocks * width - rank)))
        for b in range(blocks):
            part = values[:, b * width : (b + 1) * width]
            columns = [pa.array(np.ascontiguousarray(part[:, j])) for j in range(width)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(np.full(len(keys), b, np.int32)), *columns],
                names=["key", "block", *names],
            )

    merged = (
        few_tasks(rows.select("idx", "val", *extra))
        .mapInArrow(partials, ", ".join(["key long", "block int", *[f"{c} double" for c in names]]))
        .groupBy("key", "block")
        .agg(*[F.sum(c).alias(c) for c in names])
        .toPandas()
    )
    by_term, square = np.zeros((n_terms, blocks * width)), np.zeros((rank, blocks * width))
    for b, part in merged.groupby("block"):
        keys, values, at = part["key"].to_numpy(), part[names].to_numpy(), slice(b * width, (b + 1) * width)
        by_term[keys[keys >= 0], at] = values[keys >= 0]
        square[-1 - keys[keys < 0], at] = values[keys < 0]
    return by_term[:, :rank], square[:, :rank]


def dense_rows(rows: DataFrame, doc: str, small: Callable[[Cells], np.ndarray], out: str) -> DataFrame:
    """(doc, out): one dense vector per document, computed batch by batch."""
    kind = rows.schema[doc].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _batch(doc, batch.column(doc), out, small(Cells.of(batch)))

    return rows.select(doc, "idx", "val").mapInArrow(run, f"`{doc}` {kind}, `{out}` array<double>")


# --- truncated SVD ---------------------------------------------------------------


@dataclass(frozen=True)
class Svd:
    """Right singular vectors (terms x rank) and singular values, largest first."""

    components: np.ndarray
    values: np.ndarray

    def embed(self, rows: DataFrame, doc: str, out: str = "embedding") -> DataFrame:
        """Documents in the space of the components: U times the singular values."""
        components = self.components
        return dense_rows(rows, doc, lambda cells: cells.times(components), out)


def truncated_svd(
    rows: DataFrame, n_terms: int, rank: int, extra: int = 10, rounds: int = 5, seed: int = 42
) -> Svd:
    """Randomised subspace iteration (Halko, Martinsson, Tropp 2011) on A'A.

    ``rounds`` + 2 passes over the rows, each of which multiplies a
    (terms x (rank + extra)) basis by A'A.
    """
    width = min(n_terms, rank + extra)
    rank = min(rank, width)
    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(n_terms, width)))[0]
    for _ in range(rounds + 1):
        fixed = basis

        def gram(cells: Cells, by_term: np.ndarray, _square: np.ndarray) -> None:
            cells.add_transposed(cells.times(fixed), by_term)

        basis = np.linalg.qr(summed(rows, n_terms, width, gram)[0])[0]
    final = basis

    def inner(cells: Cells, _by_term: np.ndarray, square: np.ndarray) -> None:
        projected = cells.times(final)
        square += projected.T @ projected

    values, turn = np.linalg.eigh(summed(rows, n_terms, width, inner)[1])
    order = np.argsort(values)[::-1][:rank]
    components = final @ turn[:, order]
    # fix the sign: the entry of largest size is positive
    largest = np.abs(components).argmax(axis=0)
    components = components * np.sign(components[largest, np.arange(rank)])
    return Svd(components, np.sqrt(np.maximum(values[order], 0.0)))


# --- non-negative factorisation -----------------------------------------------------


def nonnegative_weights(cells: Cells, topics: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """Non-negative least squares of each row against the topics (rank x terms).

    Coordinate descent on the normal equations, for all rows of the batch at once.
    """
    cross, gram = cells.times(topics.T), topics @ topics.T
    weights = np.zeros_like(cross)
    for _ in range(sweeps):
        moved = 0.0
        for j in range(len(gram)):
            if gram[j, j] <= 0.0:
                continue
            new = np.maximum(0.0, weights[:, j] + (cross[:, j] - weights @ gram[:, j]) / gram[j, j])
            moved = max(moved, float(np.abs(new - weights[:, j]).max(initial=0.0)))
            weights[:, j] = new
        if moved < 1e-9:
            break
    return weights


@dataclass(frozen=True)
class Nmf:
    """Topics (rank x terms) and the squared error after each round."""

    topics: np.ndarray
    errors: tuple[float, ...]

    def weights(self, rows: DataFrame, doc: str, out: str = "weights") -> DataFrame:
        topics = self.topics
        return dense_rows(rows, doc, lambda cells: nonnegative_weights(cells, topics), out)


def _starting_topics(rows: DataFrame, n_rows: int, n_terms: int, rank: int, seed: int) -> np.ndarray:
    """Non-negative double SVD start (Boutsidis, Gallopoulos 2008), zeros set to the mean."""
    svd = truncated_svd(rows, n_terms, rank, rounds=2, seed=seed)  # a start need not be sharp
    rank = svd.components.shape[1]
    components = svd.components

    def sides(cells: Cells, by_term: np.ndarray, square: np.ndarray) -> None:
        projected = cells.times(components)
        square[0] += (np.maximum(projected, 0.0) ** 2).sum(axis=0)
        square[1 % rank] += (np.minimum(projected, 0.0) ** 2).sum(axis=0) if rank > 1 else 0.0
        by_term[:, 0] += np.bincount(cells.idx, cells.val, minlength=n_terms)

    by_term, square = summed(rows, n_terms, rank, sides)
    up, down = np.sqrt(square[0]), np.sqrt(square[1 % rank])
    topics = np.zeros((rank, n_terms))
    for j in range(rank):
        v = components[:, j]
        plus, minus = np.maximum(v, 0.0), np.maximum(-v, 0.0)
        strong_plus = up[j] * np.linalg.norm(plus) >= down[j] * np.linalg.norm(minus)
        side, size = (plus, up[j]) if strong_plus else (minus, down[j])
        length = np.linalg.norm(side)
        # size / values = norm of the matching left part
        if length > 0 and svd.values[j] > 0:
            topics[j] = np.sqrt(size * length) * side / length
    mean = by_term[:, 0].sum() / max(n_terms * n_rows, 1)
    topics[topics <= 0.0] = mean
    return topics


def nonnegative_factors(
    rows: DataFrame, n_terms: int, rank: int, max_iter: int = 400, tol: float = 1e-4, seed: int = 42
) -> Nmf:
    """Alternating non-negative least squares.

    A round solves every document against the current topics and returns the
    sums W'A and W'W; the topics are then improved by coordinate descent on
    those sums. The squared error comes from the same sums, so it costs no extra
    pass. Stops when a round gains less than ``tol`` of the first error.
    """
    squares = F.aggregate("val", F.lit(0.0), lambda s, v: s + v * v)
    n_rows, length = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(squares), F.lit(0.0))).first()
    topics = _starting_topics(rows, n_rows, n_terms, rank, seed)
    rank = len(topics)
    errors: list[float] = []
    for _ in range(max_iter):
        fixed = topics

        def solve(cells: Cells, by_term: np.ndarray, square: np.ndarray) -> None:
            weights = nonnegative_weights(cells, fixed)
            cells.add_transposed(weights, by_term)
            square += weights.T @ weights

        cross, gram = summed(rows, n_terms, rank, solve)
        topics = topics.copy()
        for _ in range(5):
            for j in range(rank):
                if gram[j, j] > 0.0:
                    step = (cross[:, j] - gram[j] @ topics) / gram[j, j]
                    topics[j] = np.maximum(0.0, topics[j] + step)
        error = length - 2.0 * float((cross.T * topics).sum()) + float((gram * (topics @ topics.T)).sum())
        errors.append(max(error, 0.0))
        if len(errors) > 1 and errors[-2] - errors[-1] <= tol * errors[0]:
            break
    return Nmf(topics, tuple(errors))
