"""Neighbours found against brute force."""

import numpy as np
from pyspark.sql import functions as F

from earshot.llm.ann import nearest


def brute(vectors, queries, k=5):
    ids = np.array(sorted(vectors))
    rows = np.array([vectors[i] for i in ids], float)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    out = {}
    for q in queries:
        cosines = rows @ rows[np.searchsorted(ids, q)]
        order = [j for j in np.lexsort((ids, -np.round(cosines, 12))) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), float(cosines[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, i) for i, v in vectors], "vec_id long, embedding array<float>, rank int")


def test_recall_on_the_sample_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    vectors = {r["vec_id"]: r["embedding"] for r in table.collect()}
    queries = [i for i in vectors if i % 50 == 0]
    want, got = brute(vectors, queries), found(nearest(table, F.col("vec_id") % 50 == 0))
    assert set(got) == set(queries) and all(len(v) == 5 for v in got.values())
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in queries)
    assert hits / (5 * len(queries)) >= 0.9
    unit = {i: np.array(v, float) / np.linalg.norm(np.array(v, float)) for i, v in vectors.items()}
    assert all(abs(s - unit[q] @ unit[i]) < 1e-12 for q, near in got.items() for i, s in near)
    assert all(near == sorted(near, key=lambda x: (-x[1], x[0])) for near in got.values())


def test_small_blocks_give_the_same(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    one = found(nearest(table, F.col("vec_id") % 50 == 0))
    assert found(nearest(table, F.col("vec_id") % 50 == 0, block=16, group=64)) == one


def test_copies_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, rng.standard_normal(8).astype(float).tolist()) for i in range(1, 40)]
    vectors += [(i, [1.0] * 8) for i in range(100, 400)] + [(400, [2.0] * 8)]
    vectors += [
        (500, None), (550, [0.0] * 8), (600, [1.0, None] + [0.0] * 6), (650, [float("nan")] * 8), (700, [float("inf")] * 8),
        (None, [1.0] * 8), (750, [1.0] * 7), (100, [1.0] * 8),
    ]
    got = found(nearest(frame(spark, vectors), F.col("vec_id") % 50 == 0))
    assert set(got) == {100, 150, 200, 250, 300, 350, 400}
    assert [i for i, _ in got[100]] == [101, 102, 103, 104, 105]
    assert [i for i, _ in got[400]] == [100, 101, 102, 103, 104]
    assert [i for i, _ in got[150]] == [100, 101, 102, 103, 104]


def test_few_or_no_candidates(spark):
    few = frame(spark, [(0, [1.0, 0.0]), (1, [0.9, 0.1]), (50, [1.0, 0.1])])
    got = found(nearest(few, F.col("vec_id") % 50 == 0, reach=0.999))
    assert [i for i, _ in got[0]] == [50, 1] or {i for i, _ in got[0]} == {1, 50}
    assert nearest(few.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_small_tables_return_all_candidates(spark):
    rng = np.random.default_rng(3)
    for n in (3, 4, 5, 6, 6, 6):
        vectors = {50 * i: rng.standard_normal(8).tolist() for i in range(n)}
        got = found(nearest(frame(spark, vectors.items()), F.col("vec_id") % 50 == 0))
        want = brute(vectors, vectors)
        assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}


def test_recall_among_near_copies(spark):
    rng = np.random.default_rng(4)
    copies = np.repeat(rng.standard_normal((120, 64)), 20, axis=0)
    rows = np.vstack([copies + 0.002 * rng.standard_normal(copies.shape), rng.standard_normal((600, 64))])
    vectors = {i: v.tolist() for i, v in enumerate(rows)}
    queries = [i for i in vectors if i % 50 == 0]
    want, got = brute(vectors, queries), found(nearest(frame(spark, vectors.items()), F.col("vec_id") % 50 == 0))
    assert set(got) == set(queries) and all(len(v) == 5 for v in got.values())
    for some in ([q for q in queries if q < len(copies)], [q for q in queries if q >= len(copies)]):
        assert sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in some) / (5 * len(some)) >= 0.9
