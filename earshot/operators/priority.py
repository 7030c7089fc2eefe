"""Priority score, tier and explanation card of each message."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.catalogue import (
    DEFAULT_SEVERITY,
    PRIORITY_WEIGHTS,
    SENTIMENT_SEVERITY,
    THEMES,
    UNCLASSIFIED,
    Theme,
)
from earshot.functions.labels import label_or_code, lookup, tier_of
from earshot.functions.numbers import capped, count_where, half_even, tanh_saturation
from earshot.operators.history import is_negative, prior_complaints
from earshot.operators.ranking import percentile_of_value

COMPONENTS = tuple(PRIORITY_WEIGHTS)


def customer_profile(feedback: DataFrame, customers: DataFrame, customer: str = "customer_id") -> DataFrame:
    """Customer columns the score needs, with the value percentile.

    The percentile is ranked over feedback rows, so each customer's value
    weighs as many rows as the customer has messages. Those are counted per
    customer first; the fact itself is never sorted by value.
    """
    known = customers.select(customer, "lifetime_value", "tier", "base_churn_prob")
    messages = feedback.groupBy(customer).agg(F.count(F.lit(1)).alias("messages"))
    weighted = known.join(messages, customer).select("lifetime_value", "messages")
    ranks = percentile_of_value(weighted, "lifetime_value", "messages", out="customer_value_score")
    return known.join(ranks, "lifetime_value", "left")


def with_components(
    feedback: DataFrame,
    customers: DataFrame,
    themes: Sequence[Theme] = THEMES,
    active: DataFrame | None = None,
    hot_day: int = 1_000_000,
) -> DataFrame:
    """Adds customer columns, primary theme and the six component scores.

    ``active`` holds the labels of themes under alert in a column ``theme``.
    """
    labels = {t.code: t.label for t in themes}
    severity = {t.code: t.severity for t in themes}
    rows = prior_complaints(
        feedback, customer_columns=customer_profile(feedback, customers), hot_day=hot_day
    )
    rows = (
        rows.withColumn("primary_theme", F.get("inferred_themes", 0))
        .withColumn("theme_severity", F.coalesce(lookup(F.col("primary_theme"), severity), F.lit(DEFAULT_SEVERITY)))
        .withColumn("theme_label_primary", lookup(F.col("primary_theme"), labels))
    )
    if active is None:
        rows = rows.withColumn("issue_growth_score", F.lit(0.0))
    else:
        # at most one row per theme
        growing = F.broadcast(
            active.select(F.col("theme").alias("theme_label_primary")).distinct().withColumn("_growing", F.lit(1.0))
        )
        rows = rows.join(growing, "theme_label_primary", "left")
        rows = rows.withColumn("issue_growth_score", F.coalesce("_growing", F.lit(0.0))).drop("_growing")
    negative = is_negative().cast("int")
    return rows.withColumns(
        {
            "sentiment_severity_score": lookup(F.col("predicted_sentiment"), SENTIMENT_SEVERITY)
            * F.col("sentiment_confidence"),
            "churn_risk_score": capped(F.col("base_churn_prob") * (F.lit(1.0) + negative * F.lit(0.5)), 1.0),
            "repeat_complaint_score": tanh_saturation(F.col("repeat_negative_count")),
        }
    )


def priority_score(weights: Mapping[str, float] = PRIORITY_WEIGHTS) -> Column:
    """Weighted sum of the components, 0-100, rounded to one decimal.

    Null when a component is null; such rows fall into the lowest tier.
    """
    total: Column | None = None
    for name, weight in weights.items():
        term = F.col(name) * F.lit(weight)
        total = term if total is None else total + term
    return half_even(total * F.lit(100.0), 1)


def score_feedback(
    feedback: DataFrame,
    customers: DataFrame,
    themes: Sequence[Theme] = THEMES,
    active: DataFrame | None = None,
    weights: Mapping[str, float] = PRIORITY_WEIGHTS,
    hot_day: int = 1_000_000,
) -> DataFrame:
    """Components, priority_score and priority_tier; the tier reads the rounded score."""
    rows = with_components(feedback, customers, themes, active, hot_day)
    return rows.withColumn("priority_score", priority_score(weights)).withColumn(
        "priority_tier", tier_of(F.col("priority_score"))
    )


def distribution(rows: DataFrame, column: str, out: str = "n") -> DataFrame:
    """Value counts with the share of all rows.

    The total is summed over the counted values, one row per category, so the
    table is read once.
    """
    counted = rows.groupBy(column).agg(F.count(F.lit(1)).alias(out))
    whole = F.sum(out).over(Window.partitionBy(F.lit(0)))
    return counted.withColumn("share", F.col(out).cast("double") / whole.cast("double"))


def urgent(tiers: Sequence[str] = ("Critical", "High")) -> Column:
    return F.col("priority_tier").isin(*tiers)


def urgent_sentiment_mix(scored: DataFrame) -> DataFrame:
    """Sentiment mix among the urgent tiers: positive feedback should be rare there."""
    return distribution(scored.where(urgent()), "predicted_sentiment")


def top_priority(scored: DataFrame, n: int = 25, row_id: str = "feedback_id") -> DataFrame:
    """The ``n`` highest scores; ties go to the smaller id."""
    return scored.orderBy(F.col("priority_score").desc_nulls_last(), F.col(row_id)).limit(n)


def explanation_cards(
    scored: DataFrame,
    themes: Sequence[Theme] = THEMES,
    n: int = 25,
) -> DataFrame:
    """Business-readable cards of the ``n`` most urgent messages."""
    labels = {t.code: t.label for t in themes}
    others = F.filter(
        F.slice("inferred_themes", 2, F.greatest(F.size("inferred_themes"), F.lit(1))),
        lambda t: t != UNCLASSIFIED,
    )
    confidence = half_even(F.col("sentiment_confidence") * 100, 0).cast("int").cast("string")
    return top_priority(scored, n).select(
        "feedback_id",
        F.concat(F.initcap("predicted_sentiment"), F.lit(" — "), confidence, F.lit("%")).alias("sentiment"),
        F.col("theme_label_primary").alias("primary_issue"),
        F.transform(others, lambda t: label_or_code(t, labels)).alias("secondary_issues"),
        tier_of(F.col("priority_score")).alias("severity"),
        F.col("tier").alias("customer_value"),
        F.col("repeat_negative_count").cast("int").alias("repeat_complaints_before_this"),
        (F.col("issue_growth_score") > 0).alias("part_of_emerging_issue"),
        F.col("priority_tier").alias("recommended_priority"),
        "priority_score",
    )


def tier_counts(scored: DataFrame) -> DataFrame:
    """Rows per tier next to the rows of the fact, and whether they add up."""
    return scored.agg(
        *[count_where(F.col("priority_tier") == t).alias(t.lower()) for t in ("Critical", "High", "Medium", "Low")],
        F.count(F.lit(1)).alias("fact_rows"),
    ).withColumn("adds_up", F.col("critical") + F.col("high") + F.col("medium") + F.col("low") == F.col("fact_rows"))
