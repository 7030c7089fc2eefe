"""Topic discovery three ways, compared by purity."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.clustering import LDA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earshot.operators.agreement import cluster_majority
from earshot.operators.classifiers import argmax
from earshot.operators import kmeans
from earshot.operators.factors import Cells, nonnegative_factors, summed, truncated_svd
from earshot.operators.features import TermRules, TextFeatures, fit_features, vector_rows

#: Terms that count for topics.
TOPIC_TERMS = TermRules(min_df=5, max_features=5_000, grams=1)


@dataclass(frozen=True)
class Corpus:
    """A corpus prepared once for all topic methods."""

    docs: DataFrame
    doc: str
    text: str
    features: TextFeatures
    rows: DataFrame

    @property
    def terms(self) -> tuple[str, ...]:
        return self.features.terms

    @cached_property
    def counted(self) -> DataFrame:
        """(doc, counts): kept for the rounds of LDA and for what it assigns, so that no text is cut again."""
        docs = self.docs.select(self.doc, self.text)
        return self.features.counts(docs, self.text).drop(self.text).persist(StorageLevel.MEMORY_AND_DISK)

    def release(self) -> None:
        self.rows.unpersist()
        if "counted" in self.__dict__:
            self.counted.unpersist()


def corpus(docs: DataFrame, doc: str, text: str, rules: TermRules = TOPIC_TERMS) -> Corpus:
    """Vocabulary and TF-IDF rows; the rows are kept because the factors read them often.

    A row depends on its document alone, so the rows are made where the text is read.
    """
    features = fit_features(docs, text, rules)
    rows = vector_rows(features.tfidf(docs.select(doc, text), text), doc, "features")
    return Corpus(docs, doc, text, features, rows.persist(StorageLevel.MEMORY_AND_DISK))


@dataclass(frozen=True)
class Topics:
    """Assignments (doc, topic, ...) and, where the method has them, term weights."""

    assigned: DataFrame
    term_weights: np.ndarray | None
    errors: tuple[float, ...] = ()


def by_nmf(data: Corpus, k: int = 10, max_iter: int = 400, seed: int = 42) -> Topics:
    model = nonnegative_factors(data.rows, len(data.terms), k, max_iter, seed=seed)
    weights = model.weights(data.rows, data.doc)
    return Topics(weights.withColumn("topic", argmax(F.col("weights"))), model.topics, model.errors)


def by_lda(
    data: Corpus, k: int = 10, passes: int = 15, share: float = 0.25, seed: int = 42
) -> Topics:
    """Online LDA. ``passes`` counts whole passes, Spark's iterations are mini-batches.

    A batch holds ``share`` of the corpus, at any size of it, so the number of
    rounds is ``passes / share`` and does not grow with the corpus.
    """
    model = LDA(
        k=k, featuresCol="counts", maxIter=math.ceil(passes / share), optimizer="online",
        subsamplingRate=share, learningOffset=10.0, learningDecay=0.7, seed=seed,
    ).fit(data.counted)
    out = model.transform(data.counted)
    found = vector_to_array("topicDistribution")
    # a document without any known term belongs to all topics alike
    alike = F.array_repeat(F.lit(1.0 / k), k)
    weights = out.select(
        data.doc, F.when(F.array_max(found) > 0, found).otherwise(alike).alias("weights")
    )
    return Topics(
        weights.withColumn("topic", argmax(F.col("weights"))), np.asarray(model.topicsMatrix().toArray()).T
    )


def lsa_embedding(data: Corpus, rank: int = 100, seed: int = 42) -> DataFrame:
    """(doc, embedding): truncated SVD of the TF-IDF rows."""
    return truncated_svd(data.rows, len(data.terms), rank, seed=seed).embed(data.rows, data.doc)


def by_kmeans(
    embedded: DataFrame, doc: str, embedding: str = "embedding", k: int = 10, restarts: int = 10, seed: int = 42
) -> Topics:
    """K-means on dense rows, the cheapest of several starts, all of which share their passes."""
    points = embedded.select(doc, embedding).persist(StorageLevel.MEMORY_AND_DISK)
    found = kmeans.fit(points, embedding, k, tuple(seed + i for i in range(restarts)))
    points.unpersist()
    return Topics(found.assign(embedded, doc, embedding), None, found.costs)


def _cluster_terms(data: Corpus, topics: Topics) -> DataFrame:
    """(topic, term, weight): the TF-IDF rows of each cluster, summed where they lie.

    Rows meet their topic by document; from there on only sums per term and topic move.
    """
    k = (topics.assigned.agg(F.max("topic")).first()[0] or 0) + 1
    rows = data.rows.join(topics.assigned.select(data.doc, F.col("topic").cast("long").alias("topic")), data.doc)
    rows = rows.where("topic IS NOT NULL")

    def add(cells: Cells, by_term: np.ndarray, _square: np.ndarray) -> None:
        np.add.at(by_term, (cells.idx, cells.extra["topic"][cells.row]), cells.val)

    by_term, _ = summed(rows, len(data.terms), k, add, extra=("topic",))
    at, topic = np.nonzero(by_term)
    table = [(int(j), data.terms[i], float(by_term[i, j])) for i, j in zip(at, topic, strict=True)]
    return data.docs.sparkSession.createDataFrame(table, "topic int, term string, weight double")


def top_terms(data: Corpus, topics: Topics, n: int = 8) -> DataFrame:
    """(topic, rank, term, weight).

    Methods with term weights use them; clusters use the summed TF-IDF of their
    documents. Either way a topic has at most one row per vocabulary term.
    """
    if topics.term_weights is not None:
        spark = data.docs.sparkSession
        table = [
            (j, term, float(w))
            for j, row in enumerate(topics.term_weights)
            for term, w in zip(data.terms, row)
            if w > 0.0
        ]
        weighted = spark.createDataFrame(table, "topic int, term string, weight double")
    else:
        weighted = _cluster_terms(data, topics)
    order = Window.partitionBy("topic").orderBy(F.col("weight").desc(), "term")
    return weighted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n).select(
        "topic", "rank", "term", "weight"
    )


def topic_names(terms: DataFrame, n: int = 3) -> DataFrame:
    """(topic, label): a topic is named after its top terms, not after known truth."""
    listed = F.array_sort(F.collect_list(F.struct("rank", "term")))
    return (
        terms.where(F.col("rank") <= n)
        .groupBy("topic")
        .agg(F.array_join(F.transform(listed, lambda x: x["term"]), " ").alias("label"))
    )


@dataclass(frozen=True)
class TopicContest:
    """Outcome of the method comparison.

    ``majorities`` is (method, topic, n, majority, hits) against the truth, for
    evaluation only; ``terms`` is (method, topic, rank, term, weight).
    """

    purity: dict[str, float]
    winner: str
    majorities: DataFrame
    terms: DataFrame
    labelled: DataFrame


def compare(data: Corpus, truth: DataFrame, k: int = 10, rank: int = 100, seed: int = 42) -> TopicContest:
    """Runs all three methods, ranks them by purity, labels all rows with the best.

    ``truth`` is (doc, truth); it only decides which method wins. The first of
    equally pure methods wins, in the order NMF, LDA, embedding + KMeans.
    """
    spark = data.docs.sparkSession
    found = {
        "nmf": by_nmf(data, k, seed=seed),
        "lda": by_lda(data, k, seed=seed),
        "embedding_kmeans": by_kmeans(lsa_embedding(data, rank, seed), data.doc, k=k, seed=seed),
    }
    # one row per topic and method
    rows = [
        (name, *row)
        for name, topics in found.items()
        for row in cluster_majority(topics.assigned.join(truth, data.doc), "topic", "truth").collect()
    ]
    scores = {
        name: sum(r[4] or 0 for r in rows if r[0] == name) / max(1, sum(r[2] for r in rows if r[0] == name))
        for name in found
    }
    winner = max(scores, key=scores.get)
    majorities = spark.createDataFrame(rows, "method string, topic int, n long, majority string, hits long")
    terms = {name: top_terms(data, topics) for name, topics in found.items()}
    listed = reduce(
        DataFrame.unionByName, [t.select(F.lit(name).alias("method"), "*") for name, t in terms.items()]
    )
    # one row per topic
    names = F.broadcast(topic_names(terms[winner]))
    labelled = found[winner].assigned.join(names, "topic", "left").select(
        data.doc, F.col("topic").alias("discovered_topic_id"), F.col("label").alias("discovered_topic_label")
    )
    return TopicContest(scores, winner, majorities, listed, labelled)
