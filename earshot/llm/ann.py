"""Approximate nearest neighbours by cosine: multiprobe p-stable hashing, exact reranking.

A unit vector is projected on ``hashes`` Gaussian directions per table and each projection
is cut into slots of a width tied to the distance at which neighbours lie. Because the
projections are p-stable, the offset between a query and a neighbour at distance r is
normal with deviation r along each direction, which gives the chance of finding the
neighbour in each slot around the query's own. A query visits perturbed buckets in the
order of their estimated success, until the chances add up to ``reach`` in each table.
Candidates of all tables are compared with the query by exact cosines and merged.

Neighbour distances are measured on a bounded sample of queries against every vector. There
is a width for each group of these distances, four at most, and queries start at the
smallest. A query is settled when it has ``k + 1`` ids, itself included, within ``COVERED``
times the distance its probes were made for; else it goes on to the next width, and after
the last it is compared with all vectors. So near copies do not set the width for the rest,
and no query returns fewer than ``k`` while others exist.

* Equal vectors are one class, represented by its ``k + 1`` smallest ids: no more can be
  asked for, and no bucket grows with the number of copies. The ids are limited before
  they are shuffled.
* Buckets are cut into blocks of bounded size, and so are the queries that visit a group
  of blocks: no task holds more than ``block`` vectors of a bucket or ``block`` queries at once.
* A task returns at most ``k + 1`` classes per query and group; pairs are never listed.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from earshot.llm.common import Shipped, mixed, sized_broadcast, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])


#: A query is settled by answers within so many times the distance of its width.
COVERED = 1.25
#: Sampled distances are grouped between these parts of the largest.
SCALES = (1 / 64, 1 / 8, 1 / 2)


@dataclass(frozen=True)
class Hashing:
    """``directions``: tables x dimension x hashes; ``shifts``: tables x hashes; slots of ``width``."""

    directions: np.ndarray
    shifts: np.ndarray
    width: float
    distance: float
    reach: float

    @classmethod
    def draw(cls, dimension: int, tables: int, hashes: int, distance: float, slots: float, reach: float) -> Hashing:
        rng = np.random.default_rng(20)
        width = max(distance, 1e-6) * slots
        return cls(
            rng.standard_normal((tables, dimension, hashes)), rng.random((tables, hashes)) * width, width,
            max(distance, 1e-6), reach,
        )

    def places(self, units: np.ndarray, table: int) -> np.ndarray:
        return (units @ self.directions[table] + self.shifts[table]) / self.width

    def bucket(self, slots: np.ndarray, table: int) -> np.ndarray:
        """One number for each row of slots."""
        total = np.full(len(slots), table + 1, np.uint64)
        for column in slots.astype(np.int64).T:
            total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + column.view(np.uint64))
        return total.view(np.int64)

    def probes(self, place: np.ndarray, table: int) -> np.ndarray:
        """Buckets of one query in falling order of estimated success, until ``reach`` is covered.

        Directions are joined one at a time and only the best ``most`` partial choices are
        kept, which loses none of the best ``most`` whole ones. If they do not cover
        ``reach``, ``most`` is doubled.
        """
        own = np.floor(place).astype(np.int64)
        most = 4096
        while True:
            steps, chance = np.zeros((1, 0), np.int64), np.ones(1)
            for inside in place - own:
                moves, odds = slot_chances(float(inside), self.width / self.distance)
                both = np.outer(chance, odds).ravel()
                best = np.argsort(-both, kind="stable")[:most]
                steps = np.column_stack([steps[best // len(moves)], moves[best % len(moves)]])
                chance = both[best]
            covered = np.cumsum(chance)
            if covered[-1] >= self.reach or len(chance) < most:
                break
            most *= 2
        count = int(np.searchsorted(covered, self.reach)) + 1
        return self.bucket(own + steps[:count], table)


def slot_chances(inside: float, width: float) -> tuple[np.ndarray, np.ndarray]:
    """Slots around the own one and the chance of a neighbour in each; ``width`` in neighbour distances."""
    far = int(4 / width) + 2
    moves = np.arange(-far, far + 1)
    edges = (np.append(moves, far + 1) - inside) * width
    below = np.array([0.5 * math.erfc(-e / math.sqrt(2)) for e in edges])
    odds = np.diff(below)
    real = odds > 1e-9
    return moves[real], odds[real]


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows over their length, without overflow or underflow on the way."""
    rows = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dimension)


def usable(vector: Column) -> Column:
    """Neither null nor zero, and all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def classes_of(rows: DataFrame, keep: int) -> DataFrame:
    """(class_id, vector, ids): one row per distinct vector with its ``keep`` smallest ids."""
    order = W.partitionBy("digest", "vector").orderBy("vec_id")
    first = rows.distinct().withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)
    ids = F.sort_array(F.collect_list("vec_id"))
    return first.groupBy("digest", "vector").agg(ids.alias("ids")).withColumn("class_id", F.get("ids", 0))


def binary(rows: DataFrame, columns: str) -> DataFrame:
    """The vector column as joined doubles, as the tasks below read it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("vector")
            packed = [np.asarray(v.values, np.float64).tobytes() for v in batch.column(at)]
            yield batch.set_column(at, "vector", pa.array(packed, pa.binary()))

    return rows.mapInArrow(run, columns)


def nearest_to(points: np.ndarray, unit_rows: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each point its ``k`` best rows as (ids, cosines), ties to the smaller id."""
    cosines = points @ unit_rows.T
    out = []
    for row in cosines:
        best = np.arange(len(row))
        if len(row) > k:
            best = np.flatnonzero(row >= np.partition(row, len(row) - k)[len(row) - k])
        best = best[np.lexsort((ids[best], -row[best]))][:k]
        out.append((ids[best], row[best]))
    return out


def neighbour_distances(classes: DataFrame, dimension: int, k: int, sample: int, quantile: float) -> list[float]:
    """Distances within which a sampled vector has its ``k`` neighbours: the ``quantile`` of each group, rising."""
    some = classes.orderBy(F.xxhash64("class_id"), "class_id").limit(sample).select("class_id", "vector").collect()
    if not some:
        return [1.0]
    own = np.array([r["class_id"] for r in some])
    points = units(np.frombuffer(b"".join(r["vector"] for r in some), np.float64).reshape(-1, dimension))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids = batch.column(0).to_numpy()
                found = nearest_to(points, units(matrix(batch.column(1), dimension)), ids, k + 1)
                for point, (near, cosines) in zip(own.tolist(), found, strict=True):
                    yield pa.RecordBatch.from_pydict({
                        "point": np.full(len(near), point), "near": near, "cosine": cosines,
                    })

    rows = classes.select("class_id", "vector").mapInArrow(run, "point long, near long, cosine double")
    order = W.partitionBy("point").orderBy(F.desc("cosine"))
    rows = rows.where("point <> near").withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    worst = rows.groupBy("point").agg(F.min("cosine").alias("cosine")).collect()  # one row per sampled vector
    if not worst:
        return [1.0]
    far = np.array([math.sqrt(max(0.0, 2 - 2 * r["cosine"])) for r in worst])
    group = np.searchsorted(np.array(SCALES) * far.max(), far)
    return [float(np.quantile(far[group == g], quantile)) for g in np.unique(group)]


def by_buckets(
    found: DataFrame, total: int, points: DataFrame, hashing: Hashing, block: int, group: int,
) -> tuple[DataFrame, DataFrame]:
    """Rows that ``reranker`` takes: the blocks of buckets and the queries that visit them."""
    dimension, tables = hashing.directions.shape[1], len(hashing.directions)
    shared = Shipped(found.sparkSession, hashing)  # tables x dimension x hashes numbers

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points = units(matrix(batch.column(1), dimension))
                for t in range(tables):
                    slots_of = np.floor(shared.value.places(points, t))
                    yield pa.RecordBatch.from_arrays(
                        [*batch.columns[:3], pa.array(shared.value.bucket(slots_of, t))],
                        names=["class_id", "vector", "ids", "bucket"],
                    )

    indexed = found.select("class_id", "vector", "ids").mapInArrow(
        index, "class_id long, vector binary, ids array<long>, bucket long"
    )
    blocks = F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks")
    sizes = sized_broadcast(stored(indexed.groupBy("bucket").agg(blocks), "buckets"))
    groups = max(1, -(-total * tables // group))
    unit, in_group = F.xxhash64("bucket", "part"), F.pmod(F.xxhash64("bucket", "part"), F.lit(groups))
    part = F.pmod(F.xxhash64("class_id"), F.col("blocks"))
    members = indexed.join(sizes, "bucket").withColumn("part", part.cast("int"))
    members = members.select(in_group.alias("home"), unit.alias("unit"), "class_id", "vector", "ids")

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at = units(matrix(batch.column(1), dimension))
            for t in range(tables):
                for query, place in zip(batch.column(0), shared.value.places(at, t), strict=True):
                    buckets = shared.value.probes(place, t)
                    yield pa.RecordBatch.from_pydict({
                        "query": np.full(len(buckets), query.as_py()), "bucket": buckets,
                    })

    probes = points.mapInArrow(visit, "query long, bucket long").join(sizes, "bucket")
    probes = probes.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    probes = probes.select("query", in_group.alias("home"), unit.alias("unit"))
    visits = probes.groupBy("home", "query").agg(F.collect_list("unit").alias("units"))
    visits = stored(visits, "visits")
    crews = visits.groupBy("home").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("crews"))
    crews = sized_broadcast(stored(crews, "crews"))
    crew = F.pmod(F.xxhash64("query"), F.col("crews")).cast("int").alias("crew")
    left = members.join(crews, "home").withColumn("crew", F.explode(F.sequence(F.lit(0), F.col("crews") - 1)))
    right = visits.join(crews, "home").join(points, "query").select("home", crew, "query", "vector", "units")
    return left, right


def against_all(
    found: DataFrame, total: int, points: DataFrame, asking: int, block: int,
) -> tuple[DataFrame, DataFrame]:
    """The same for a comparison of all classes with all of ``asking`` points."""
    homes, crews = -(-total // block), -(-asking // block)
    home = F.pmod(F.xxhash64("class_id"), F.lit(homes)).cast("long").alias("home")
    crew = F.pmod(F.xxhash64("query"), F.lit(crews)).cast("int").alias("crew")
    left = found.select(home, F.lit(0).cast("long").alias("unit"), "class_id", "vector", "ids")
    left = left.withColumn("crew", F.explode(F.sequence(F.lit(0), F.lit(crews - 1))))
    right = points.select(crew, "query", "vector", F.array(F.lit(0).cast("long")).alias("units"))
    return left, right.withColumn("home", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(homes - 1).cast("long"))))


def reranker(dimension: int, k: int):
    """Best classes of each query among the units it visits, for one home and crew."""

    def rerank(members, queries):
        rows_of: dict[int, list[int]] = {}
        for row, unit_id in enumerate(members.column("unit").to_pylist()):
            rows_of.setdefault(unit_id, []).append(row)
        asking: dict[int, list[int]] = {}
        for row, visited in enumerate(queries.column("units").to_pylist()):
            for unit_id in visited:
                asking.setdefault(unit_id, []).append(row)
        ids = members.column("class_id").to_numpy()
        at = units(matrix(members.column("vector"), dimension)) if members.num_rows else None
        of = units(matrix(queries.column("vector"), dimension)) if queries.num_rows else None
        best: dict[int, dict[int, tuple[float, int]]] = {}
        for unit_id, some in asking.items():
            own = np.array(rows_of.get(unit_id, ()), np.int64)
            if len(own):
                for query, (near, cosines) in zip(some, nearest_to(of[some], at[own], ids[own], k + 1), strict=True):
                    best.setdefault(query, {}).update(zip(near.tolist(), cosines.tolist(), strict=True))
        row_of = {c: r for r, c in enumerate(ids.tolist())}
        names, out = queries.column("query").to_pylist(), []
        lists = members.column("ids").to_pylist() if best else []
        for query, near in best.items():
            some = np.array([row_of[class_id] for class_id in near])
            cosines = (of[query] * at[some]).sum(axis=1)  # the same bits whatever the blocks
            for place in np.lexsort((ids[some], -cosines))[: k + 1]:
                out.append((names[query], int(ids[some[place]]), float(cosines[place]), lists[some[place]]))
        return pa.table({
            "query": pa.array([o[0] for o in out], pa.int64()), "class_id": pa.array([o[1] for o in out], pa.int64()),
            "score": pa.array([o[2] for o in out], pa.float64()),
            "ids": pa.array([o[3] for o in out], pa.list_(pa.int64())),
        })

    return rerank


def best_ids(left: DataFrame, right: DataFrame, dimension: int, k: int) -> DataFrame:
    """(query, vec_id, score): the ``k + 1`` best ids of every query."""
    merged = left.groupBy("home", "crew").cogroup(right.groupBy("home", "crew")).applyInArrow(
        reranker(dimension, k), "query long, class_id long, score double, ids array<long>"
    )
    merged = merged.groupBy("query", "class_id").agg(F.max("score").alias("score"), F.first("ids").alias("ids"))
    by_class = W.partitionBy("query").orderBy(F.desc("score"), "class_id")
    merged = merged.withColumn("place", F.row_number().over(by_class)).where(F.col("place") <= k + 1)
    each = merged.select("query", "score", F.explode("ids").alias("vec_id"))
    by_id = W.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    each = each.groupBy("query", "vec_id").agg(F.max("score").alias("score"))
    return each.withColumn("place", F.row_number().over(by_id)).where(F.col("place") <= k + 1).drop("place")


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 5, tables: int = 2, hashes: int = 6, slots: float = 1.8,
    reach: float = 0.77, block: int = 4096, group: int = 16_384, sample: int = 64,
    vec_id: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row where ``is_query``.

    ``is_query`` is a predicate on the column ``vec_id``; candidates are all rows with
    another id; the score is the cosine in double precision; ties go to the smaller id; with
    fewer candidates all are returned.

    Null and zero vectors, vectors with null or non-finite components, rows without an id
    and vectors of another length than the commonest (ties: the longest) take no part.
    Equal rows count once; an id with several vectors is found by its best one, and as a
    query it returns the best over its vectors. Other columns are ignored; an empty table
    gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")
    ).where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    lengths = rows.groupBy(F.size("vector").alias("length")).agg(F.count("*").alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dimension = common["length"]
    zero = F.transform("vector", lambda x: x + F.lit(0.0))  # one zero, not two
    rows = rows.where(F.size("vector") == dimension).withColumn("vector", zero)
    rows = rows.withColumn("digest", F.xxhash64("vector"))
    found = stored(
        binary(
            classes_of(rows, k + 1).select("class_id", "vector", "ids", "digest"),
            "class_id long, vector binary, ids array<long>, digest long",
        ),
        "vector-classes",
    )
    total = found.count()
    asked = rows.where(is_query).select("vec_id", "digest", "vector").distinct()
    asked = binary(asked, "vec_id long, digest long, vector binary")
    asked = stored(
        asked.join(found.select("digest", "vector", "class_id"), ["digest", "vector"]).select("vec_id", "class_id"),
        "queries",
    )
    points = found.select("class_id", "vector").join(asked.select("class_id").distinct(), "class_id", "left_semi")
    points = stored(points.withColumnRenamed("class_id", "query"), "query-vectors")
    open_points, parts = points, []
    for distance in neighbour_distances(found, dimension, k, sample, 0.75):
        hashing = Hashing.draw(dimension, tables, hashes, distance, slots, reach)
        left, right = by_buckets(found, total, open_points, hashing, block, group)
        parts.append(stored(best_ids(left, right, dimension, k), "answers"))
        near = parts[-1].where(F.col("score") >= 1 - (COVERED * hashing.distance) ** 2 / 2)
        settled = near.groupBy("query").agg(F.count("*").alias("n")).where(F.col("n") > k).select("query")
        open_points = stored(open_points.join(settled, "query", "left_anti"), "open-queries")
    asking = open_points.count()
    if asking:
        parts.append(best_ids(*against_all(found, total, open_points, asking, block), dimension, k))
    each = reduce(DataFrame.unionByName, parts)
    answers = asked.withColumnRenamed("vec_id", "query_id").withColumnRenamed("class_id", "query").join(each, "query")
    answers = answers.where("query_id <> vec_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    final = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    answers = answers.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
    return answers.select("query_id", "rank", "vec_id", "score")
