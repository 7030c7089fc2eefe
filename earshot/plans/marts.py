"""One flat table per dashboard page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.catalogue import NEGATIVE, POSITIVE
from earshot.functions.numbers import count_where, exact_mean, half_even, rate
from earshot.operators.priority import urgent
from earshot.sources.facts import last_day

FACT_COLUMNS = (
    "feedback_id", "customer_id", "product_id", "channel", "feedback_date",
    "predicted_sentiment", "sentiment_confidence", "theme_label_primary",
    "priority_score", "priority_tier", "churn_risk_score", "tier", "lifetime_value",
)


def negative() -> Column:
    return F.col("predicted_sentiment") == NEGATIVE


def volume() -> Column:
    return F.count("feedback_id")


def mean_score() -> Column:
    return exact_mean(F.col("priority_score")).alias("avg_priority_score")


def negative_rate() -> Column:
    return rate(negative()).alias("negative_rate")


def present(*keys: str) -> Column:
    """Rows whose group keys are all known: unknown ones have no page entry."""
    test = F.lit(True)
    for key in keys:
        test = test & F.col(key).isNotNull()
    return test


def fact_feedback(scored: DataFrame) -> DataFrame:
    return scored.select(*FACT_COLUMNS)


def executive(
    scored: DataFrame,
    alerts: DataFrame | None = None,
    churn_cut: float = 0.5,
    days: int = 30,
    dates: DataFrame | None = None,
) -> DataFrame:
    """One row of headline figures, from counts per theme and the distinct customers at risk.

    ``dates`` is any table with the same ``feedback_date`` values. Where the
    scored table is not stored yet, pass the unscored one: its last day then
    costs a one-column scan instead of a second scoring run.
    """
    last = last_day(scored if dates is None else dates)
    n_alerts = F.lit(0).cast("long") if alerts is None else alerts.agg(F.count(F.lit(1))).scalar()

    # one row per theme: everything that adds up, and the negatives to find the mode
    theme = F.col("theme_label_primary")
    by_theme = scored.groupBy(theme).agg(
        F.count(F.lit(1)).alias("rows"),
        count_where(negative()).alias("negatives"),
        count_where(F.col("predicted_sentiment") == POSITIVE).alias("positives"),
        count_where(F.col("priority_tier") == "Critical").alias("critical"),
        count_where(urgent()).alias("urgent"),
        count_where(F.col("feedback_date") > F.date_sub(last, days)).alias("recent"),
        F.max("feedback_date").alias("last_day"),
    )
    at_risk = scored.where(F.col("churn_risk_score") > churn_cut).select("customer_id").where("customer_id IS NOT NULL")
    at_risk = at_risk.distinct().agg(F.count(F.lit(1))).scalar()
    rows = F.sum("rows").cast("double")

    def percent(part: str) -> Column:
        return F.sum(part) / rows * 100

    named = theme.isNotNull() & (F.col("negatives") > 0)
    # of equally frequent themes the first by name
    first = F.min(F.when(named, F.struct((-F.col("negatives")).alias("less"), theme.alias("theme"))))
    return by_theme.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_feedback"),
        half_even(percent("negatives"), 1).alias("negative_sentiment_pct"),
        half_even(percent("positives"), 1).alias("csat_proxy_pct"),
        F.coalesce(F.sum("critical"), F.lit(0)).alias("critical_complaints_count"),
        half_even(F.lit(100.0) - percent("urgent"), 1).alias("resolution_rate_proxy_pct"),
        first.getField("theme").alias("top_complaint_topic"),
        F.coalesce(F.sum("recent"), F.lit(0)).alias("last_30d_feedback_volume"),
        F.max("last_day").alias("as_of_date"),
    ).withColumn("at_risk_customers_count", at_risk).select(
        "total_feedback", "negative_sentiment_pct", "csat_proxy_pct", n_alerts.alias("emerging_issues_count"),
        "critical_complaints_count", "resolution_rate_proxy_pct", "at_risk_customers_count",
        "top_complaint_topic", "last_30d_feedback_volume", "as_of_date",
    )


def sentiment_trend(scored: DataFrame) -> DataFrame:
    month = F.date_format("feedback_date", "yyyy-MM").alias("month")
    return (
        scored.where(present("feedback_date", "predicted_sentiment"))
        .groupBy(month, F.col("predicted_sentiment").alias("sentiment"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("month", "sentiment")
    )


def topic(scored: DataFrame) -> DataFrame:
    return (
        scored.where(present("theme_label_primary"))
        .groupBy("theme_label_primary")
        .agg(volume().alias("volume"), negative_rate(), mean_score())
        .orderBy(F.col("volume").desc(), "theme_label_primary")
    )


def product(scored: DataFrame, products: DataFrame) -> DataFrame:
    """Feedback per product. Counted per product first, then joined."""
    per_product = (
        scored.where(present("product_id"))
        .groupBy("product_id")
        .agg(volume().alias("feedback_volume"), negative_rate(), mean_score())
    )
    known = products.where(present("product_id", "category", "quality_risk"))
    return (
        known.select("product_id", "category", "quality_risk")
        .join(per_product, "product_id")
        .orderBy(F.col("negative_rate").desc(), "product_id")
    )


def channel(scored: DataFrame) -> DataFrame:
    return (
        scored.where(present("channel"))
        .groupBy("channel")
        .agg(
            volume().alias("volume"), negative_rate(), mean_score(),
            count_where(F.col("priority_tier") == "Critical").alias("critical_count"),
        )
        .orderBy("channel")
    )


def customer_risk(scored: DataFrame) -> DataFrame:
    keys = ("customer_id", "tier", "lifetime_value")
    return (
        scored.where(present(*keys))
        .groupBy(*keys)
        .agg(
            volume().alias("feedback_count"),
            count_where(negative()).alias("negative_count"),
            exact_mean(F.col("churn_risk_score")).alias("avg_churn_risk_score"),
            F.max("priority_score").alias("max_priority_score"),
        )
        .orderBy(F.col("avg_churn_risk_score").desc(), "customer_id")
    )


def action_queue(scored: DataFrame) -> DataFrame:
    """Urgent messages, highest score first."""
    return (
        scored.where(urgent())
        .select(
            "feedback_id", "customer_id", "tier", "channel", "feedback_date",
            "theme_label_primary", "predicted_sentiment", "priority_score", "priority_tier",
        )
        .orderBy(F.col("priority_score").desc(), "feedback_id")
    )
