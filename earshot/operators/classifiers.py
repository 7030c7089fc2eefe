"""Sentiment classifiers: fit, compare, score everything with the best one."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark import StorageLevel
from pyspark.ml.classification import LinearSVC, LinearSVCModel, LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.catalogue import SENTIMENTS
from earshot.functions.labels import lookup
from earshot.functions.numbers import half_even
from earshot.operators.agreement import classification_report, confusion_matrix
from earshot.operators.features import TermRules, TextFeatures, fit_features
from earshot.operators.ranking import stratified_split
from earshot.session import scratch_dir, side_by_side, without_summary

#: Adds ``predicted_sentiment`` and ``sentiment_confidence`` to rows of text.
Scorer = Callable[[DataFrame], DataFrame]


def argmax(values: Column) -> Column:
    """Position of the largest value; the first one wins."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def margin_confidence(rows: DataFrame, margin: str, out: str = "sentiment_confidence") -> DataFrame:
    """Margins min-max scaled over the table into [0.5, 1], three decimals."""
    edge = rows.agg(F.struct(F.min(margin).alias("low"), F.max(margin).alias("high"))).scalar()
    scaled = (F.col(margin) - edge["low"]) / F.nullif(edge["high"] - edge["low"], F.lit(0.0))
    return rows.withColumn(out, half_even(F.lit(0.5) + F.lit(0.5) * scaled, 3))


def with_class_weights(rows: DataFrame, label: str, labels: Sequence[str]) -> tuple[DataFrame, int]:
    """Adds ``label_idx`` and balanced ``class_weight`` = n / (classes * n_class)."""
    known = rows.where(F.col(label).isin(*labels))
    counts = {r[label]: r["count"] for r in known.groupBy(label).count().collect()}
    n = sum(counts.values())
    weight = {c: n / (len(counts) * k) for c, k in counts.items()}
    position = {c: float(i) for i, c in enumerate(labels)}
    return known.withColumn("class_weight", lookup(F.col(label), weight)).withColumn(
        "label_idx", lookup(F.col(label), position)
    ), n


def _label_at(position: Column, labels: Sequence[str]) -> Column:
    return F.get(F.array(*[F.lit(x) for x in labels]), position)


@dataclass(frozen=True)
class TrainingSet:
    """Weighted training vectors, kept for all models that are fitted on them."""

    rows: DataFrame
    n: int
    features: TextFeatures
    text: str
    labels: tuple[str, ...]

    def batches(self, rows_per_task: int = 10_000) -> DataFrame:
        """The kept rows in tasks of useful size.

        Every task of every round sends back a dense gradient (classes x
        features), which only pays off over enough rows. Merging partitions
        moves no data; the tasks of a large set follow the cluster, not the set.
        """
        cores = self.rows.sparkSession.sparkContext.defaultParallelism
        return self.rows.coalesce(max(1, min(math.ceil(self.n / rows_per_task), 2 * cores)))

    def release(self) -> None:
        self.rows.unpersist()


def training_set(
    train: DataFrame, doc: str, text: str, label: str, rules: TermRules = TermRules(),
    labels: Sequence[str] = SENTIMENTS,
) -> TrainingSet:
    train = train.select(doc, text, label).persist(StorageLevel.MEMORY_AND_DISK)
    features = fit_features(train, text, rules)
    weighted, n = with_class_weights(train, label, labels)
    rows = features.tfidf(weighted, text).select("label_idx", "class_weight", "features")
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    rows.count()
    train.unpersist()
    return TrainingSet(rows, n, features, text, tuple(labels))


def fit_logistic(data: TrainingSet, c: float = 3.0, max_iter: int = 1000, tol: float = 1e-4) -> Scorer:
    """Multinomial logistic regression with balanced class weights.

    ``c`` weighs the summed loss against half the squared norm; Spark averages
    the loss over the weights, which add up to n, so the penalty is 1 / (c n).
    """
    model = LogisticRegression(
        family="multinomial", featuresCol="features", labelCol="label_idx", weightCol="class_weight",
        regParam=1.0 / (c * data.n), elasticNetParam=0.0, standardization=False, maxIter=max_iter, tol=tol,
    ).fit(data.batches())
    model = without_summary(model)

    def score(rows: DataFrame) -> DataFrame:
        scored = model.transform(data.features.tfidf(rows, data.text))
        return scored.withColumn(
            "predicted_sentiment", _label_at(F.col("prediction").cast("int"), data.labels)
        ).withColumn(
            "sentiment_confidence", half_even(F.array_max(vector_to_array("probability")), 3)
        ).drop("features", "rawPrediction", "probability", "prediction")

    return score


def fit_svm(data: TrainingSet, c: float = 1.0, max_iter: int = 1000, tol: float = 1e-4) -> Scorer:
    """Linear SVM per class against the rest; the largest margin wins.

    The class models score one after another in the JVM and leave their margin
    in a column each, so no row passes through Python.
    """
    batches = data.batches()

    def fit_one(i: int) -> LinearSVCModel:
        one = batches.withColumn("is_class", (F.col("label_idx") == float(i)).cast("double"))
        return without_summary(LinearSVC(
            featuresCol="features", labelCol="is_class", weightCol="class_weight",
            rawPredictionCol="raw", predictionCol="hit",
            regParam=1.0 / (c * data.n), standardization=False, maxIter=max_iter, tol=tol,
        ).fit(one))

    models = side_by_side(batches.sparkSession, [partial(fit_one, i) for i in range(len(data.labels))])

    def margins(rows: DataFrame) -> DataFrame:
        out = data.features.tfidf(rows, data.text)
        for i, model in enumerate(models):
            out = model.transform(out).withColumn(f"margin_{i}", vector_to_array("raw")[1]).drop("raw", "hit")
        return out.drop("features")

    def score(rows: DataFrame) -> DataFrame:
        names = [f"margin_{i}" for i in range(len(models))]
        out = margins(rows).withColumn("_margins", F.array(*names))
        out = out.withColumn("predicted_sentiment", _label_at(argmax(F.col("_margins")), data.labels))
        out = out.withColumn("_top", F.array_max("_margins")).drop("_margins", *names)
        # the scale needs the smallest and the largest margin of the table: written once, the text is
        # not cut into terms a second time for them
        path = scratch_dir(rows.sparkSession, "svm-margins")
        out.write.parquet(path)
        return margin_confidence(rows.sparkSession.read.schema(out.schema).parquet(path), "_top").drop("_top")

    return score


@dataclass(frozen=True)
class Judgement:
    """How one model did on held-out rows; both tables have a handful of rows."""

    matrix: DataFrame
    report: DataFrame
    macro_f1: float


def judge(scored: DataFrame, truth: str, labels: Sequence[str] = SENTIMENTS) -> Judgement:
    """One pass over the scored rows; only the label x label counts reach the driver."""
    counted = confusion_matrix(scored, truth, "predicted_sentiment", labels)
    matrix = scored.sparkSession.createDataFrame(counted.collect(), counted.schema)
    report = classification_report(matrix, labels)
    return Judgement(matrix, report, report.where(F.col("label") == "macro avg").first()["f1"])


@dataclass(frozen=True)
class Contest:
    """Outcome of the model comparison."""

    judged: dict[str, Judgement]
    winner: str
    scorers: dict[str, Scorer]

    @property
    def macro_f1(self) -> dict[str, float]:
        return {name: j.macro_f1 for name, j in self.judged.items()}

    def score(self, rows: DataFrame) -> DataFrame:
        return self.scorers[self.winner](rows)


def compare(
    labelled: DataFrame,
    doc: str,
    text: str,
    truth: str,
    rule_based: Scorer,
    rules: TermRules = TermRules(),
    labels: Sequence[str] = SENTIMENTS,
    share: float = 0.2,
    seed: int = 42,
) -> Contest:
    """Fits both models on the training rows and ranks all three on held-out rows.

    The first of equally good models wins, in the order rule based, logistic, SVM.
    """
    split = stratified_split(labelled, truth, doc, share, seed).persist(StorageLevel.MEMORY_AND_DISK)
    train, held_out = split.where(~F.col("is_test")), split.where("is_test")
    data = training_set(train, doc, text, truth, rules, labels)
    scorers: dict[str, Scorer] = {
        "rule_based": rule_based,
        "tfidf_logreg": fit_logistic(data),
        "tfidf_linear_svm": fit_svm(data),
    }
    data.release()
    judged = {name: judge(score(held_out), truth, labels) for name, score in scorers.items()}
    split.unpersist()
    return Contest(judged, max(judged, key=lambda name: judged[name].macro_f1), scorers)
