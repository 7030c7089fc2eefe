"""Text quality by a vote of the nearest labelled texts in a latent-semantic space.

A text becomes counts of its hashed byte trigrams (case and symbols included), damped and
weighted by inverse document frequency over the whole corpus, beside a few rates of
repetition and make-up that no trigram shows. Both are projected on the leading singular
directions of a bounded sample of labelled texts. The labelled latent
vectors are shipped to every task; each document's cosine with every one of them is
computed in blocks, and its nearest labelled texts vote with weights that grow with
similarity.

Nothing is shuffled but one row of document frequencies per task and trigram bucket.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm.common import Shipped, give_back
from earshot.llm.words import text_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rates of ``style_rates``, and how much they weigh beside the unit vector of the trigrams.
STYLES, STYLE_WEIGHT = 6, 1.5


@dataclass(frozen=True)
class Model:
    """``weights``: inverse document frequencies; ``axes``: features x rank; ``points``: latent unit
    vectors of the labelled texts, whose labels are ``marks``; ``prior``: share of label 1."""

    weights: np.ndarray
    axes: np.ndarray
    points: np.ndarray
    marks: np.ndarray
    prior: float


def trigram_counts(texts: list[str], buckets: int, most: int = 1 << 18) -> np.ndarray:
    """(texts x buckets) counts of hashed byte trigrams; texts under three bytes have none."""
    out = np.zeros((len(texts), buckets), np.float32)
    shift = np.uint32(32 - (buckets.bit_length() - 1))
    for row, text in enumerate(texts):
        raw = text.encode()
        for at in range(0, len(raw) - 2, most):
            data = np.frombuffer(raw[at: at + most + 2], np.uint8).astype(np.uint32)
            code = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
            out[row] += np.bincount((code * np.uint32(2654435761)) >> shift, minlength=buckets)
    return out


def style_rates(texts: list[str]) -> np.ndarray:
    """(texts x STYLES) shares between 0 and 1; an empty text has none."""
    out = np.zeros((len(texts), STYLES), np.float32)
    for row, text in enumerate(texts):
        words = text.lower().split()
        if not words:
            continue
        lines = [line for line in text.split("\n") if line.strip()]
        n = len(words)
        letters = sum(map(len, words))
        out[row] = (
            sum(map(str.__eq__, words, words[1:])) / n,
            1 - len(set(words)) / n,
            1 - len(set(lines)) / len(lines),
            sum(map(str.isalpha, words)) / n,
            min(1.0, letters / n / 20),
            min(1.0, np.log1p(n) / 12),
        )
    return out


def document_frequencies(docs: DataFrame, buckets: int, text: str = "text") -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, over all rows, and the number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets + 1, np.int64)
        for _, texts in text_batches(batches, 1 << 20):
            for at in range(0, len(texts), 256):
                total[:buckets] += (trigram_counts(texts[at: at + 256], buckets) > 0).sum(axis=0)
            total[buckets] += len(texts)
        if total[buckets]:
            yield pa.RecordBatch.from_pydict({"bucket": np.arange(buckets + 1, dtype=np.int32), "n": total})
        give_back()

    parts = docs.select(F.lit(0).alias("none"), F.col(text)).mapInArrow(run, "bucket int, n long")
    rows = parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # buckets + 1 rows at most
    found = np.zeros(buckets + 1, np.int64)
    for row in rows:
        found[row["bucket"]] = row["n"]
    return found[:buckets], int(found[buckets])


def features(counts: np.ndarray, rates: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Unit rows of damped, weighted counts, with the weighted rates behind them."""
    rows = np.log1p(counts) * weights
    rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)
    return np.concatenate([rows, STYLE_WEIGHT * rates], axis=1)


def latent(rows: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Rows projected on ``axes``, as unit vectors; a row without features stays zero."""
    low = rows @ axes
    return low / np.maximum(np.linalg.norm(low, axis=1, keepdims=True), 1e-12)


def singular_axes(rows: np.ndarray, rank: int, rounds: int = 4) -> np.ndarray:
    """Leading right singular directions, by subspace iteration from a fixed start."""
    start = np.random.default_rng(7).standard_normal((rows.shape[1], rank + 8)).astype(np.float32)
    basis = np.linalg.qr(start)[0]
    for _ in range(rounds):
        basis = np.linalg.qr(rows.T @ (rows @ basis))[0]
    _, _, turn = np.linalg.svd(rows @ basis, full_matrices=False)
    return (basis @ turn.T)[:, :rank].astype(np.float32)


def fit(
    docs: DataFrame, labels: DataFrame, label: str, train: Column, sample: int = 4096, buckets: int = 4096,
    rank: int = 64, doc_id: str = "doc_id", text: str = "text",
) -> Model:
    """Learns from at most ``sample`` labelled rows that satisfy ``train``, a predicate on ``doc_id``.

    The sample is the documented bound of the model: the rows with the smallest hash of
    their id. Rows without id or label are not used. Without any labelled row every text
    scores one half.
    """
    frequency, n = document_frequencies(docs, buckets, text)
    weights = np.log((1 + n) / (1 + frequency)).astype(np.float32)
    known = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("mark"))
    known = known.where(train & F.col("doc_id").isNotNull() & F.col("mark").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("mark").alias("mark"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    pairs = texts.join(F.broadcast(chosen), "doc_id").select("mark", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for marks, part in text_batches(batches, 1 << 20):
            for at in range(0, len(part), 256):
                rows = trigram_counts(part[at: at + 256], buckets).astype(np.uint32)
                cells = [np.flatnonzero(r).astype(np.uint16) for r in rows]
                yield pa.RecordBatch.from_pydict({
                    "mark": pa.array(marks[at: at + 256], pa.int32()),
                    "cells": [c.tobytes() for c in cells],
                    "counts": [r[c].tobytes() for r, c in zip(rows, cells, strict=True)],
                    "rates": [r.tobytes() for r in style_rates(part[at: at + 256])],
                })

    got = pairs.mapInArrow(run, "mark int, cells binary, counts binary, rates binary").collect()
    got.sort(key=lambda r: (r["mark"], r["cells"], r["counts"], r["rates"]))  # the fit must not depend on arrival
    marks = np.array([r["mark"] for r in got], np.float32)
    if not got:
        return Model(weights, np.zeros((buckets + STYLES, 1), np.float32), np.zeros((0, 1), np.float32), marks, 0.5)
    rows = np.zeros((len(got), buckets + STYLES), np.float32)  # filled in place: the driver holds it once
    for row, r in zip(rows, got, strict=True):
        counts = np.zeros((1, buckets), np.float32)
        counts[0, np.frombuffer(r["cells"], np.uint16)] = np.frombuffer(r["counts"], np.uint32)
        row[:] = features(counts, np.frombuffer(r["rates"], np.float32)[None], weights)[0]
    del got
    axes = singular_axes(rows, min(rank, *rows.shape))
    return Model(weights, axes, latent(rows, axes), marks, float(marks.mean()))


def vote(points: np.ndarray, model: Model, nearest: int = 25, sharpness: int = 8, block: int = 2048) -> np.ndarray:
    """Share of label 1 among the nearest labelled points, each weighing cosine ** sharpness.

    The base rate takes part with a small weight; it decides alone where nothing is similar.
    """
    best = np.zeros((len(points), 0), np.float32)
    marks = np.zeros((len(points), 0), np.float32)
    for at in range(0, len(model.points), block):
        part = model.points[at: at + block]
        cosines = np.concatenate([best, points @ part.T], axis=1)
        votes = np.concatenate([marks, np.broadcast_to(model.marks[at: at + block], (len(points), len(part)))], axis=1)
        keep = min(nearest, cosines.shape[1])
        order = np.argpartition(-cosines, keep - 1, axis=1)[:, :keep]
        best, marks = np.take_along_axis(cosines, order, 1), np.take_along_axis(votes, order, 1)
    weight = np.maximum(best, 0).astype(np.float64) ** sharpness
    return ((weight * marks).sum(axis=1) + 0.01 * model.prior) / (weight.sum(axis=1) + 0.01)


def score_of(text: Column, model: Model) -> Column:
    """The score of a text, in 0 to 1; null, empty and shorter than three-byte texts score near the base rate."""
    spark = SparkSession.active()
    shared = Shipped(spark, model)  # sample x rank and features x rank numbers
    buckets = len(model.weights)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fitted = shared.value
        for batch in batches:
            texts, scores = [t or "" for t in batch], [np.empty(0)]
            for at in range(0, len(texts), 256):
                part = texts[at: at + 256]
                rows = features(trigram_counts(part, buckets), style_rates(part), fitted.weights)
                scores.append(vote(latent(rows, fitted.axes), fitted))
            yield pd.Series(np.clip(np.concatenate(scores), 0.0, 1.0))
        give_back()

    return run(F.coalesce(text, F.lit("")))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row.

    Long texts are read whole; repeated rows score alike; null ids are kept; other columns
    are ignored; an empty table gives no rows.
    """
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), score_of(F.col(text), model).alias("score"))
