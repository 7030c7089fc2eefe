"""Vectors as short codes: one codebook for each part of a vector, learned in integers.

A component x is the integer floor(1024 * x). A vector is cut into equal parts, and each
part is coded by the nearest of up to 256 entries of its codebook, in squared Euclidean
distance, ties to the lower index. To find it, parts and entries are padded with zeros
to a power of two P and go through an integer Walsh-Hadamard transform, which multiplies
every squared distance by P exactly. Squared differences are added up coefficient by
coefficient in sequency order; an entry whose sum has passed the full distance of
another entry is out. All of it is integer arithmetic, so the codes are exact.

Defined cases: rows whose vector is null or holds null, NaN or infinite components are
left out. A vector shorter than the longest one, or one whose length the parts do not
divide, is read as followed by zeros. Integers are held within +-2**30 / P (for 64
components in four parts: x within +-65,536), the range in which no distance overflows. With
fewer rows than ``entries`` the codebooks are shorter; an empty table gives no rows. Rows that
share an id are all coded; among them the codebook takes the smaller vectors first, and a
null id comes last. Other columns of ``vectors`` are neither read nor returned.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from earshot.llm.common import Shipped, sized_broadcast, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows whose distances to all entries are held at once.
_ROWS = 512


def sequency_order(size: int) -> np.ndarray:
    """Places of the rows of the natural Hadamard matrix by their number of sign changes."""
    bits = size.bit_length() - 1
    natural = np.arange(size)
    rank = np.zeros(size, np.int64)
    for b in range(bits):
        rank |= ((natural >> b) & 1) << (bits - 1 - b)
    for shift in (1 << b for b in range(bits.bit_length())):
        rank ^= rank >> shift  # Gray code to number
    return np.argsort(rank)


def walsh(parts: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of the last axis, zero-padded, in sequency order."""
    length = parts.shape[-1]
    size = 1 << max(0, length - 1).bit_length()
    out = np.zeros((*parts.shape[:-1], size), parts.dtype)
    out[..., :length] = parts
    half = 1
    while half < size:
        pairs = out.reshape(*parts.shape[:-1], size // (2 * half), 2, half)
        above, below = pairs[..., 0, :] + pairs[..., 1, :], pairs[..., 0, :] - pairs[..., 1, :]
        pairs[..., 0, :], pairs[..., 1, :] = above, below
        half *= 2
    return out[..., sequency_order(size)]


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest entry of each transformed point.

    Three quarters of the coefficients are summed for all entries, in place and without
    gathering anything. The full distance of the entry that then leads is a bound: only pairs
    not beyond it go on to the next strip of coefficients, after each of which the others drop out.
    """
    size = points.shape[1]
    dense, strip = max(1, 3 * size // 4), max(1, size // 8)
    most = max(int(abs(points).max(initial=0)), int(abs(entries).max(initial=0)))
    kind = np.int32 if 4 * size * most * most < 2**31 else np.int64
    points, entries = points.astype(kind), entries.astype(kind)
    partial = np.zeros((len(points), len(entries)), kind)
    step = np.empty_like(partial)
    for c in range(dense):
        np.subtract(points[:, c, None], entries[None, :, c], out=step)
        np.multiply(step, step, out=step)
        partial += step
    rest = points - entries[partial.argmin(1)]
    bound = np.einsum("ij,ij->i", rest, rest)
    row, entry = np.divmod(np.flatnonzero(partial <= bound[:, None]), len(entries))
    total = partial[row, entry]
    for at in range(dense, size, strip):
        rest = points[row, at : at + strip] - entries[entry, at : at + strip]
        total = total + np.einsum("ij,ij->i", rest, rest)
        on = total <= bound[row]
        row, entry, total = row[on], entry[on], total[on]
    least = np.minimum.reduceat(total, np.flatnonzero(np.diff(row, prepend=-1))) if len(row) else total
    first = np.flatnonzero(total == least[row])  # every point keeps its leading entry at least
    first = first[np.diff(row[first], prepend=-1) != 0]
    return entry[first], total[first].astype(np.int64) // size


@dataclass(frozen=True)
class Shape:
    """How vectors are cut: components of the longest vector, parts, and the integer scale."""

    components: int
    parts: int = 4
    scale: int = 1024

    @property
    def length(self) -> int:
        return max(1, -(-self.components // self.parts))

    @property
    def most(self) -> int:
        return 2**30 // (1 << max(0, self.length - 1).bit_length())

    def integers(self, vectors: pa.Array) -> np.ndarray:
        """(rows, parts, length) of a list array."""
        sizes = np.diff(vectors.offsets.to_numpy())
        values = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64)
        whole = np.clip(np.floor(values * self.scale), -self.most, self.most).astype(np.int64)
        out = np.zeros((len(sizes), self.parts * self.length), np.int64)
        row = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(whole)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[row, place] = whole
        return out.reshape(len(sizes), self.parts, self.length)


@dataclass(frozen=True)
class Codebooks:
    """Entries of all parts: an array (parts, entries, length) of integers."""

    entries: np.ndarray

    def assign(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, squared distances), both (rows, parts)."""
        codes = np.empty(parts.shape[:2], np.int64)
        errors = np.empty(parts.shape[:2], np.int64)
        for part, book in enumerate(self.entries):
            turned = walsh(book)
            for at in range(0, len(parts), _ROWS):
                run = slice(at, at + _ROWS)
                codes[run, part], errors[run, part] = nearest(walsh(parts[run, part]), turned)
        return codes, errors

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def complete(vector: Column) -> Column:
    """Whether a vector is present and all its components are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return F.coalesce(finite, F.lit(False))


def learn(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
    parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024,
) -> tuple[Shape, Codebooks]:
    """Codebooks after ``rounds`` of assigning every vector and replacing entries by floored means.

    They start as the parts of the ``entries`` smallest ids. In a round each task adds
    up the integers of its own vectors by entry; only these sums are shuffled, and
    parts x entries x length of them reach the driver.
    """
    spark = vectors.sparkSession
    kept = vectors.where(complete(F.col(vector))).select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    longest = kept.agg(F.max(F.size("vector"))).first()[0]
    shape = Shape(longest or 0, parts, scale)
    first = kept.orderBy(F.col("key").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    start = shape.integers(pa.array([r[0] for r in first], pa.list_(pa.float64())))
    books = Codebooks(np.ascontiguousarray(start.transpose(1, 0, 2)))
    if not first:
        return shape, books

    for _ in range(rounds):
        shipped = Shipped(spark, books)

        def sums(batches: Iterator[pa.RecordBatch], shipped: Shipped = shipped) -> Iterator[pa.RecordBatch]:
            now: Codebooks = shipped.value
            shape_of = now.entries.shape
            total = np.zeros((*shape_of[:2], shape_of[2] + 1), np.int64)  # the last place counts
            for batch in batches:
                whole = shape.integers(batch.column(0))
                codes, _ = now.assign(whole)
                for part in range(shape_of[0]):
                    order = np.argsort(codes[:, part], kind="stable")
                    met = codes[order, part]
                    at = np.flatnonzero(np.diff(met, prepend=-1))
                    if len(at):
                        total[part, met[at], :-1] += np.add.reduceat(whole[order, part], at)
                        total[part, met[at], -1] += np.diff(np.append(at, len(met)))
            used = np.flatnonzero(np.repeat(total[..., -1].ravel() > 0, total.shape[2]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int64()), pa.array(total.ravel()[used], pa.int64())], names=["cell", "total"]
            )

        cells = kept.select("vector").mapInArrow(sums, "cell long, total long").groupBy("cell").agg(F.sum("total"))
        merged = np.zeros((*books.entries.shape[:2], books.entries.shape[2] + 1), np.int64)
        for cell, total in cells.collect():
            merged.flat[cell] = total
        count = merged[..., -1:]
        moved = merged[..., :-1] // np.maximum(count, 1)
        books = Codebooks(np.where(count > 0, moved, books.entries))
    return shape, books


def encode(
    vectors: DataFrame, shape: Shape, books: Codebooks,
    key: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """(key, label, code, error): two hex digits a part, and the squared distance of the coded vector."""
    shipped = Shipped(vectors.sparkSession, books)
    rows = vectors.where(complete(F.col(vector))).select(
        F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).alias("vector")
    )
    kinds = [to_arrow_type(rows.schema[name].dataType) for name in ("key", "label")]

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Codebooks = shipped.value
        for batch in batches:
            codes, errors = now.assign(shape.integers(batch.column(2)))
            text = [bytes(c).hex() for c in codes.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(kinds[0]), batch.column(1).cast(kinds[1]),
                    pa.array(text, pa.string()), pa.array(errors.sum(1), pa.int64()),
                ],
                names=["key", "label", "code", "error"],
            )

    kind = {name: rows.schema[name].dataType.simpleString() for name in ("key", "label")}
    schema = f"key {kind['key']}, label {kind['label']}, code string, error long"
    return rows.mapInArrow(coded, schema).withColumnsRenamed({"key": key, "label": label})


def with_label_error(codes: DataFrame, label: str = "label", out: str = "label_error") -> DataFrame:
    """Adds the error summed over all rows of an equal label, nulls together; null beyond a long.

    Rows are summed before the join, so a hot label reaches it as one row.
    """
    per_label = stored(codes.groupBy(F.col(label).alias("_sum_of")).agg(F.try_sum("error").alias(out)), "label-errors")
    return codes.join(sized_broadcast(per_label), F.col(label).eqNullSafe(F.col("_sum_of")), "left").drop("_sum_of")


def compress(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024,
) -> DataFrame:
    """(key, label, code, error, label_error, codebooks_sha256) of every complete vector."""
    if not 1 <= entries <= 256:
        raise ValueError("a code of two hex digits has 1 to 256 entries")
    shape, books = learn(vectors, key, vector, parts, entries, rounds, scale)
    codes = stored(encode(vectors, shape, books, key, vector, label), "vector-codes")
    return with_label_error(codes, label).withColumn("codebooks_sha256", F.lit(books.sha256))
