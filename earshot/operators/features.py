"""Term counts and TF-IDF, as tables and as vectors.

Counting is relational, so the vocabulary is deterministic (ties go to the
smaller term), and only its ``max_features`` rows ever reach the driver.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from earshot.functions.text import WORDS, bind, tokens, word_grams

# Executors need not have this package installed: helpers travel with their tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Largest vocabulary, by its own limit, that is sent to every executor.
BROADCAST_TERMS = 200_000


@dataclass(frozen=True)
class TermRules:
    """Which terms of a text count."""

    min_df: int = 3
    max_features: int = 20_000
    grams: int = 2
    stop_words: tuple[str, ...] = ()
    pattern: str = WORDS

    def terms(self, text: Column) -> Column:
        words = tokens(text, self.pattern)
        if self.stop_words:
            words = F.filter(words, lambda w: ~w.isin(*self.stop_words))
        if self.grams == 1:
            return words
        return bind(words, lambda w: word_grams(w, self.grams))


def english_stop_words() -> tuple[str, ...]:
    """Spark's own English list; needs a running session."""
    return tuple(StopWordsRemover.loadDefaultStopWords("english"))


def term_frequencies(docs: DataFrame, text: str, rules: TermRules) -> DataFrame:
    """(term, df, cf): documents that hold a term, and its occurrences.

    Each document emits two lists, its terms and its distinct terms, which are taken
    apart without a row made for each term. Both are merged by term map-side, so the
    shuffle carries one row per term and task and never (document, term) pairs.
    """
    lists = bind(rules.terms(F.col(text)), lambda words: F.array(words, F.array_distinct(words)))
    return (
        docs.select(F.posexplode(lists).alias("first", "terms"))
        .select("first", F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(F.sum("first").alias("df"), F.sum(1 - F.col("first")).alias("cf"))
    )


def vocabulary(docs: DataFrame, text: str, rules: TermRules) -> DataFrame:
    """(term, df, cf, idx): the most frequent terms, numbered in term order.

    At most ``max_features`` rows, found by a distributed top-k.
    """
    frequent = (
        term_frequencies(docs, text, rules)
        .where(F.col("df") >= rules.min_df)
        .orderBy(F.col("cf").desc(), "term")
        .limit(rules.max_features)
    )
    return frequent.withColumn("idx", F.row_number().over(Window.orderBy("term")) - 1)


def bounded(words: DataFrame, rules: TermRules) -> DataFrame:
    """Hints a vocabulary for broadcast where its limit proves it small."""
    return F.broadcast(words) if rules.max_features <= BROADCAST_TERMS else words


def smooth_idf(df: Column, n: Column) -> Column:
    return F.log((F.lit(1) + n) / (F.lit(1) + df)) + F.lit(1.0)


def known_terms(docs: DataFrame, doc: str, text: str, rules: TermRules, words: DataFrame) -> DataFrame:
    """Counts of known terms per document: (doc, columns of words, tf).

    Unknown terms are dropped right after they are cut out of the text, so only
    vocabulary counts are shuffled.
    """
    cut = docs.select(doc, F.explode(rules.terms(F.col(text))).alias("term"))
    numbered = cut.join(bounded(words.select("term", "idx"), rules), "term")
    # counted by number: the shuffled rows are narrow and of fixed width
    counts = numbered.groupBy(doc, "idx").agg(F.count(F.lit(1)).alias("tf"))
    return counts.join(bounded(words, rules), "idx")


def vocabulary_counts(docs: DataFrame, doc: str, text: str, rules: TermRules) -> DataFrame:
    """(doc, term, idx, tf) over the vocabulary."""
    words = vocabulary(docs, text, rules).select("term", "idx")
    return known_terms(docs, doc, text, rules, words).select(doc, "term", "idx", "tf")


def tfidf_weights(docs: DataFrame, doc: str, text: str, rules: TermRules) -> DataFrame:
    """(doc, term, idx, tf, weight): smoothed idf, each document scaled to length 1."""
    words = vocabulary(docs, text, rules).select("term", "idx", "df")
    counts = known_terms(docs, doc, text, rules, words)
    n = docs.agg(F.count(F.lit(1))).scalar()
    raw = counts.withColumn("raw", F.col("tf") * smooth_idf(F.col("df"), n))
    return raw.select(doc, "term", "idx", "tf", _unit(doc).alias("weight"))


def sparse_rows(docs: DataFrame, doc: str, weights: DataFrame, value: str) -> DataFrame:
    """(doc, idx array, val array) with one row per document, empty ones included.

    A row is bounded by the vocabulary, whatever the length of the document.
    """
    cells = weights.groupBy(doc).agg(
        F.array_sort(F.collect_list(F.struct("idx", F.col(value).cast("double").alias("val")))).alias("cells")
    )
    return docs.select(doc).join(cells, doc, "left").select(
        doc,
        F.coalesce(F.col("cells.idx"), F.array().cast("array<int>")).alias("idx"),
        F.coalesce(F.col("cells.val"), F.array().cast("array<double>")).alias("val"),
    )


def vector_rows(rows: DataFrame, doc: str, column: str) -> DataFrame:
    """(doc, idx array, val array) of a sparse vector column, where the vectors are made: nothing is shuffled."""
    kind = rows.schema[doc].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(1)  # type, size, indices, values
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), vectors.field("indices"), vectors.field("values")], names=["doc", "idx", "val"]
            )

    return rows.select(doc, column).mapInArrow(run, f"doc {kind}, idx array<int>, val array<double>").withColumnRenamed("doc", doc)


@dataclass(frozen=True)
class TextFeatures:
    """A fitted vocabulary: turns text into vectors where the text is read."""

    terms: tuple[str, ...]
    idf: tuple[float, ...]
    rules: TermRules

    def counts(self, rows: DataFrame, text: str, out: str = "counts") -> DataFrame:
        model = CountVectorizerModel.from_vocabulary(list(self.terms), inputCol="_terms", outputCol=out)
        return model.transform(rows.withColumn("_terms", self.rules.terms(F.col(text)))).drop("_terms")

    def tfidf(self, rows: DataFrame, text: str, out: str = "features") -> DataFrame:
        counted = self.counts(rows, text, "_counts")
        scale = ElementwiseProduct(scalingVec=Vectors.dense(self.idf), inputCol="_counts", outputCol="_scaled")
        unit = Normalizer(p=2.0, inputCol="_scaled", outputCol=out)
        return unit.transform(scale.transform(counted)).drop("_counts", "_scaled")


    def table(self, spark: SparkSession) -> DataFrame:
        """(term, idx, idf), bounded by ``max_features``."""
        rows = [(term, i, idf) for i, (term, idf) in enumerate(zip(self.terms, self.idf))]
        return spark.createDataFrame(rows, "term string, idx int, idf double")

    def weights(self, docs: DataFrame, doc: str, text: str) -> DataFrame:
        """(doc, term, idx, tf, weight) by the fitted vocabulary."""
        counted = known_terms(docs, doc, text, self.rules, self.table(docs.sparkSession))
        raw = counted.withColumn("raw", F.col("tf") * F.col("idf"))
        return raw.select(doc, "term", "idx", "tf", _unit(doc).alias("weight"))


def _unit(doc: str) -> Column:
    """``raw`` over the length of its document's ``raw`` vector."""
    return F.col("raw") / F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(doc)))


def feature_profile(rows: DataFrame, features: TextFeatures, column: str = "features") -> DataFrame:
    """(term, n_docs, weight_sum) of a column of fitted vectors.

    Summed as vectors; only the one summary row is taken apart.
    """
    summary = Summarizer.metrics("numNonZeros", "sum").summary(F.col(column)).alias("s")
    arrays = rows.select(summary).select(
        vector_to_array("s.numNonZeros").alias("n"), vector_to_array("s.sum").alias("w")
    )
    each = arrays.select(F.posexplode(F.arrays_zip("n", "w")).alias("idx", "x"))
    terms = features.table(rows.sparkSession).select("idx", "term")
    return each.join(terms, "idx").select(
        "term", F.col("x.n").cast("long").alias("n_docs"), F.col("x.w").alias("weight_sum")
    )


def fit_features(docs: DataFrame, text: str, rules: TermRules) -> TextFeatures:
    """Vocabulary and idf of a corpus; only those ``max_features`` rows are fetched."""
    n = docs.agg(F.count(F.lit(1))).scalar()
    rows = (
        vocabulary(docs, text, rules)
        .select("idx", "term", smooth_idf(F.col("df"), n).alias("idf"))
        .orderBy("idx")
        .collect()
    )
    if not rows:
        raise ValueError("no term is frequent enough for a vocabulary")
    return TextFeatures(tuple(r.term for r in rows), tuple(r.idf for r in rows), rules)
