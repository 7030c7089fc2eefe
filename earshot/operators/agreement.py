"""How far detected labels agree with known ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.catalogue import SENTIMENTS
from earshot.functions.labels import lookup
from earshot.functions.numbers import count_where, ratio


def aspect_agreement(
    messages: DataFrame,
    theme_aspects: Mapping[str, str | None],
    truth: str = "true_aspect_sentiments",
    detected: str = "detected_aspects",
) -> DataFrame:
    """One row: correct pairs, pairs that have an aspect, and their ratio.

    ``truth`` is an array of (theme, sentiment), ``detected`` an array of
    (aspect, Sentiment) with one entry per aspect. Counted message by message,
    then summed: no join and no shuffle but the final sum.
    """
    known = {theme: aspect for theme, aspect in theme_aspects.items() if aspect}
    pairs = F.transform(truth, lambda t: F.struct(lookup(t["theme"], known).alias("aspect"), F.initcap(t["sentiment"]).alias("sentiment")))
    mappable = F.filter(pairs, lambda p: p["aspect"].isNotNull())
    correct = F.filter(mappable, lambda p: F.array_contains(F.col(detected), p))
    counted = messages.select(F.size(mappable).alias("n"), F.size(correct).alias("ok"))
    summed = counted.agg(
        F.coalesce(F.sum(F.when(F.col("n") > 0, F.col("ok"))), F.lit(0)).alias("correct"),
        F.coalesce(F.sum(F.when(F.col("n") > 0, F.col("n"))), F.lit(0)).alias("total"),
    )
    return summed.select("correct", "total", F.coalesce(ratio(F.col("correct"), F.col("total")), F.lit(0.0)).alias("agreement"))


def confusion_matrix(
    labelled: DataFrame, truth: str, predicted: str, labels: Sequence[str] = SENTIMENTS
) -> DataFrame:
    """Every (truth, predicted) cell over the label list, zero cells included."""
    spark = labelled.sparkSession
    grid = spark.createDataFrame([(a, b) for a in labels for b in labels], "truth string, predicted string")
    cells = labelled.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return grid.join(cells, ["truth", "predicted"], "left").select(
        "truth", "predicted", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


def classification_report(matrix: DataFrame, labels: Sequence[str] = SENTIMENTS) -> DataFrame:
    """Per-label, macro and weighted precision, recall, F1 and support, plus accuracy.

    Works on the label x label counts of :func:`confusion_matrix`. A zero
    denominator gives zero. The accuracy row holds the accuracy in all columns.
    """
    hit = F.col("truth") == F.col("predicted")
    per_label = (
        matrix.select(
            F.explode(F.array(
                F.struct(F.col("truth").alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("claimed")),
                F.struct(F.col("predicted").alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("claimed")),
            )).alias("c"),
            F.when(hit, F.col("n")).otherwise(0).alias("hits"),
        )
        .groupBy("c.label")
        .agg(
            F.sum("c.support").alias("support"),
            F.sum("c.claimed").alias("claimed"),
            # each cell was seen twice, once per side
            (F.sum("hits") / 2).cast("long").alias("hits"),
        )
    )
    zero = F.lit(0.0)
    scored = per_label.select(
        "label", "support", "hits",
        F.coalesce(ratio(F.col("hits"), F.col("claimed")), zero).alias("precision"),
        F.coalesce(ratio(F.col("hits"), F.col("support")), zero).alias("recall"),
        F.coalesce(ratio(2 * F.col("hits"), F.col("claimed") + F.col("support")), zero).alias("f1"),
    )
    measures = ("precision", "recall", "f1")
    total = F.sum("support")
    summary = scored.agg(
        total.alias("total"),
        *[F.avg(m).alias(f"macro_{m}") for m in measures],
        *[(F.sum(F.col(m) * F.col("support")) / total).alias(f"weighted_{m}") for m in measures],
        ratio(F.sum("hits"), total).alias("accuracy"),
    )
    rows = [
        F.struct(F.lit("macro avg").alias("label"), *[F.col(f"macro_{m}").alias(m) for m in measures], F.col("total").alias("support")),
        F.struct(F.lit("weighted avg").alias("label"), *[F.col(f"weighted_{m}").alias(m) for m in measures], F.col("total").alias("support")),
        F.struct(F.lit("accuracy").alias("label"), *[F.col("accuracy").alias(m) for m in measures], F.col("total").alias("support")),
    ]
    averages = summary.select(F.inline(F.array(*rows)))
    return scored.select("label", *measures, "support").unionByName(averages)


def cluster_majority(rows: DataFrame, cluster: str, truth: str) -> DataFrame:
    """(cluster, n, majority, hits): ties go to the smallest truth label."""
    cells = rows.groupBy(F.col(cluster).alias("cluster"), F.col(truth).alias("truth")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # the least (-count, label) is the largest count and, among ties, the smallest label
    best = F.min(F.when(F.col("truth").isNotNull(), F.struct((-F.col("n")).alias("minus_n"), "truth")))
    return (
        cells.groupBy("cluster")
        .agg(F.sum("n").alias("n"), best.alias("best"))
        .select("cluster", "n", F.col("best.truth").alias("majority"), (-F.col("best.minus_n")).alias("hits"))
    )


def purity(rows: DataFrame, cluster: str, truth: str) -> DataFrame:
    """One row: share of rows that carry their cluster's majority label."""
    top = cluster_majority(rows, cluster, truth)
    return top.agg(
        F.sum("hits").alias("hits"), F.sum("n").alias("n"),
        ratio(F.sum("hits"), F.sum("n")).alias("purity"),
    )


def majority_rows(rows: DataFrame, key: str, label: str) -> DataFrame:
    """(key, negatives, neutrals, positives) counted over a message's labels."""
    negative, neutral, positive = SENTIMENTS
    return rows.groupBy(key).agg(
        count_where(F.col(label) == negative).alias("negatives"),
        count_where(F.col(label) == neutral).alias("neutrals"),
        count_where(F.col(label) == positive).alias("positives"),
    )
