"""Stupid-backoff scores of documents, by joins with n-gram count tables.

Every document is a start mark and its words; words outside the vocabulary (the
``vocabulary`` commonest words, a parameter of the model) are one unknown word. With
c the counts over all documents, a word w after v scores c(vw) / c(v) if the pair
occurs at least ``least`` times, and ``discount`` * c(w) / N otherwise. A document's
score is the sum of the logarithms.

* Word counts are merged map-side and then by hash; the vocabulary, of fixed size, is
  shipped to the tasks.
* Pair counts are merged map-side and then partitioned by the hash of the pair; pairs
  below ``least`` leave the table.
* Every document is exploded into its distinct pairs with their counts, joined to the
  pair table by the pair, and summed per document. A pair is one row per document at
  most, and Spark may split a pair that very many documents hold.

Logarithms are rounded to millionths and summed as integers, so the order of rows
changes no bit.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import Shipped, stored
from earshot.llm.words import text_batches, word_numbers

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Word ids: unknown, start of a document, then the vocabulary.
UNKNOWN, START, FIRST = 0, 1, 2
#: Stands for "a text with words" among the word numbers when words are counted.
MARK = 0
#: A pair is one integer: id of the word before, shifted, plus the id of the word.
SHIFT = 24


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with the sums of their counts."""
    keys = np.concatenate([k for k, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    distinct, place = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(place, weights=counts, minlength=len(distinct)).astype(np.int64)


def batches_of(keys: np.ndarray, counts: np.ndarray, most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(keys), most):
        yield pa.RecordBatch.from_pydict({
            "key": pa.array(keys[at: at + most].view(np.int64)), "n": pa.array(counts[at: at + most]),
        })


def counted(docs: DataFrame, keys_of, text: str, flush: int = 4 << 20) -> DataFrame:
    """(key, n) over all texts; ``keys_of(numbers, borders)`` gives the keys of a batch of texts.

    Counts are merged within a task up to ``flush`` keys at a time, then by key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for _, texts in text_batches(batches):
            keys, counts = np.unique(keys_of(*word_numbers(texts)), return_counts=True)
            parts.append((keys, counts))
            held += len(keys)
            if held >= flush:
                parts = [merged(parts)]
                held = len(parts[0][0])
                if held >= flush // 2:
                    yield from batches_of(*parts[0])
                    parts, held = [], 0
        if parts:
            yield from batches_of(*merged(parts))

    rows = docs.select(F.lit(0).alias("none"), F.col(text).alias("text")).mapInArrow(run, "key long, n long")
    return rows.groupBy("key").agg(F.sum("n").alias("n"))


class Vocabulary:
    """Word numbers to ids, by a sorted table of fixed size."""

    def __init__(self, words: np.ndarray):
        order = np.argsort(words)
        self.words, self.ids = words[order], (order + FIRST).astype(np.int64)

    def __call__(self, numbers: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.full(len(numbers), UNKNOWN, np.int64)
        place = np.minimum(np.searchsorted(self.words, numbers), len(self.words) - 1)
        return np.where(self.words[place] == numbers, self.ids[place], UNKNOWN)

    def pairs(self, numbers: np.ndarray, borders: np.ndarray) -> np.ndarray:
        """The pair that ends at each word; a text's first word follows the start mark."""
        ids = self(numbers)
        before = np.empty_like(ids)
        before[1:] = ids[:-1]
        before[borders[:-1][np.diff(borders) > 0]] = START
        return (before << SHIFT) | ids


def exploded(docs: DataFrame, shared, doc_id: str, text: str) -> DataFrame:
    """(doc_id, pair, n): a document's distinct pairs; a text without words is one row without a pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for ids, texts in text_batches(batches, 1 << 20):
            numbers, borders = word_numbers(texts)
            row = np.repeat(np.arange(len(texts)), np.diff(borders))
            pairs = vocabulary.pairs(numbers, borders)
            order = np.lexsort((pairs, row))
            row, pairs = row[order], pairs[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (pairs[1:] != pairs[:-1])
            at = np.flatnonzero(new)
            keys = pa.array(ids, pa.int64())
            yield pa.RecordBatch.from_pydict({
                "doc_id": keys.take(pa.array(row[at])), "pair": pa.array(pairs[at]),
                "n": pa.array(np.diff(np.append(at, len(row)))),
            })
            none = np.flatnonzero(np.diff(borders) == 0)
            if len(none):
                yield pa.RecordBatch.from_pydict({
                    "doc_id": keys.take(pa.array(none)), "pair": pa.nulls(len(none), pa.int64()),
                    "n": pa.array(np.zeros(len(none), np.int64)),
                })

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, pair long, n long")


def micro_log(x):
    return F.round(F.log(x) * 1_000_000).cast("long")


def lm_scores(
    docs: DataFrame, vocabulary: int = 65_536, least: int = 2, discount: float = 0.4,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, n_words, log_score_micro, mean_log_score): natural logarithms; the mean is per word.

    The counts are those of ``docs`` itself. Ties at the end of the vocabulary go to the
    smaller word number. Null, empty and blank texts have no words, a score of 0 and no
    mean; rows that share a ``doc_id`` (null included) are scored together; other columns
    are ignored; an empty table gives no rows.
    """
    if not 0 < vocabulary < (1 << SHIFT) - FIRST:
        raise ValueError("vocabulary out of range")
    spark = docs.sparkSession
    words = stored(counted(docs, marked, text), "lm-words")
    kept = words.where(F.col("key") != MARK).orderBy(F.desc("n"), "key").limit(vocabulary).toPandas()
    known = Vocabulary(kept["key"].to_numpy(np.int64).view(np.uint64))
    total, texts = words.select(
        F.coalesce(F.sum(F.when(F.col("key") != MARK, F.col("n"))), F.lit(0)),
        F.coalesce(F.sum(F.when(F.col("key") == MARK, F.col("n"))), F.lit(0)),
    ).first()

    # ``vocabulary`` + 2 rows: safe to ship to every task
    counts = [total - int(kept["n"].sum()), texts, *kept["n"].tolist()]
    single = spark.createDataFrame([(i, n) for i, n in enumerate(counts) if n > 0], "id long, count long")
    single = single.withColumn("log_count", micro_log(F.col("count"))).select("id", "log_count")

    shared = Shipped(spark, known)
    pairs = counted(docs, lambda numbers, borders: shared.value.pairs(numbers, borders), text)
    seen = pairs.where(F.col("n") >= least).select(F.col("key").alias("pair"), micro_log(F.col("n")).alias("log_pair"))
    seen = seen.join(F.broadcast(single), F.shiftright("pair", SHIFT) == single.id)
    seen = stored(seen.select("pair", (F.col("log_pair") - F.col("log_count")).alias("log_seen")), "lm-pairs")

    rows = exploded(docs, shared, doc_id, text).join(seen, "pair", "left")
    rows = rows.join(F.broadcast(single), F.col("pair").bitwiseAND((1 << SHIFT) - 1) == single.id, "left")
    rest = int(round(math.log(discount) * 1e6)) - (int(round(math.log(total) * 1e6)) if total else 0)
    each = F.coalesce("log_seen", F.col("log_count") + F.lit(rest).cast("long"))
    summed = rows.groupBy("doc_id").agg(
        F.sum("n").alias("n_words"), F.sum(F.coalesce(F.col("n") * each, F.lit(0))).alias("log_score_micro")
    )
    mean = F.col("log_score_micro") / F.lit(1e6) / F.nullif("n_words", F.lit(0))
    return summed.withColumn("mean_log_score", mean)


def marked(numbers: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """The words of a batch, and a mark for each text that has any."""
    return np.append(numbers, np.full(int((np.diff(borders) > 0).sum()), MARK, np.uint64))
