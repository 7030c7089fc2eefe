"""The quality classifier on held-out rows and on odd input."""

import numpy as np
from pyspark.sql import functions as F

from earshot.llm import quality
from earshot.llm.queries import QUERIES, quality_model


def auc(scores, marks):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(order))
    ranks[order] = np.arange(1, len(order) + 1)
    n, m = (marks == 1).sum(), (marks == 0).sum()
    return (ranks[marks == 1].sum() - n * (n + 1) / 2) / (n * m)


def test_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = QUERIES["op8_quality_scores"](spark, folder).join(labels, "doc_id").where("held_out").toPandas()
    assert auc(rows.score.to_numpy(), rows.quality.to_numpy()) > 0.98
    assert (rows.predicted == rows.quality).mean() > 0.97
    assert rows[rows.quality == 1].predicted.mean() > 0.98


def test_held_out_labels_are_not_read(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.expr("if(crc32(cast(doc_id as string)) % 4 = 2, 1 - quality, quality)"))
    one, other = quality_model(docs, labels), quality_model(docs, turned)
    assert np.array_equal(one.points, other.points) and np.array_equal(one.marks, other.marks)


def test_votes_equal_brute_force():
    rng = np.random.default_rng(0)
    points, known = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (rng.standard_normal((20, 6)), rng.standard_normal((90, 6))))
    marks = rng.integers(0, 2, 90).astype(np.float32)
    model = quality.Model(np.ones(1), np.ones((1, 1)), known.astype(np.float32), marks, 0.5)
    got = quality.vote(points.astype(np.float32), model, nearest=7, sharpness=4, block=16)
    for point, score in zip(points, got, strict=True):
        cosines = known @ point
        best = np.argsort(-cosines)[:7]
        weight = np.maximum(cosines[best], 0) ** 4
        assert abs(score - ((weight * marks[best]).sum() + 0.005) / (weight.sum() + 0.01)) < 1e-3


def test_odd_rows_and_no_labels(spark, sf_dir):
    docs = spark.createDataFrame(
        [(1, None, 0.0), (2, "", 0.0), (None, "ab", 0.0), (3, "x " * 100000, 0.0), (3, "x " * 100000, 0.0)],
        "doc_id long, text string, score double",
    )
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    known = quality_model(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels)
    got = [tuple(r) for r in quality.score(docs, known).collect()]
    assert len(got) == 5 and all(0 <= s <= 1 for _, s in got)
    blind = quality_model(docs, labels.limit(0))
    assert all(s == 0.5 for _, s in map(tuple, quality.score(docs, blind).collect()))
    assert quality.score(docs.limit(0), known).count() == 0
