"""The nine standing reports over the scored feedback table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.catalogue import NEGATIVE
from earshot.functions.numbers import count_where, exact_mean, half_away
from earshot.sources.facts import from_day, last_day


def negative() -> Column:
    return F.col("predicted_sentiment") == NEGATIVE


def percent_of(count: str, whole: Column) -> Column:
    return half_away(F.lit(100.0) * F.col(count) / whole.cast("double"), 2)


def sentiment_trend_month(scored: DataFrame) -> DataFrame:
    """Messages per month and sentiment, and their share of the month."""
    month = F.date_format("feedback_date", "yyyy-MM").alias("month")
    counted = scored.groupBy(month, "predicted_sentiment").agg(F.count(F.lit(1)).alias("feedback_count"))
    whole = F.sum("feedback_count").over(Window.partitionBy("month"))
    return counted.withColumn("pct_of_month", percent_of("feedback_count", whole)).orderBy(
        F.asc_nulls_last("month"), F.asc_nulls_last("predicted_sentiment")
    )


def worsening_products(
    scored: DataFrame,
    products: DataFrame,
    by: str = "product_id",
    days: int = 90,
    least: int = 20,
    n: int = 25,
) -> DataFrame:
    """Products whose negative rate rose most against the period before.

    Both periods come out of one pass with conditional counts. The recent one
    includes its first day, so it spans ``days`` + 1 calendar days. Reads only
    base columns, so the unscored table will do; of a table stored by month, only the months concerned.
    """
    last = last_day(scored)
    day = F.col("feedback_date")
    recent = day >= F.date_sub(last, days)
    counts = ("n_recent", "neg_recent", "n_prior", "neg_prior")
    # counted per product before the join, so the dimension meets no fact rows
    split = (
        from_day(scored, F.date_sub(last, 2 * days))
        .groupBy("product_id")
        .agg(
            count_where(recent).alias("n_recent"),
            count_where(recent & negative()).alias("neg_recent"),
            count_where(~recent).alias("n_prior"),
            count_where(~recent & negative()).alias("neg_prior"),
        )
        .join(products.select("product_id", "category"), "product_id")
    )
    names = ["product_id", "category"] if by == "product_id" else [by]
    if by != "product_id":
        split = split.groupBy(by).agg(*[F.sum(c).alias(c) for c in counts])
    thick = split.where((F.col("n_recent") >= least) & (F.col("n_prior") >= least))
    now = F.col("neg_recent").cast("double") / F.col("n_recent")
    then = F.col("neg_prior").cast("double") / F.col("n_prior")
    return (
        thick.select(
            *names, "n_recent", now.alias("neg_rate_recent"), then.alias("neg_rate_prior"),
            half_away(now - then, 3).alias("pct_point_change"),
        )
        .orderBy(F.col("pct_point_change").desc(), *names)
        .limit(n)
    )


def complaint_mix(scored: DataFrame) -> DataFrame:
    """Complaints by issue and channel, and their share of all complaints."""
    counted = (
        scored.where(negative())
        .groupBy(F.col("theme_label_primary").alias("issue_category"), "channel")
        .agg(F.count(F.lit(1)).alias("complaint_count"))
    )
    # over the counted cells, one row per issue and channel
    whole = F.sum("complaint_count").over(Window.partitionBy(F.lit(0)))
    return counted.withColumn("pct_of_all_complaints", percent_of("complaint_count", whole)).orderBy(
        F.col("complaint_count").desc(), F.asc_nulls_last("issue_category"), F.asc_nulls_last("channel")
    )


def repeat_complainers(scored: DataFrame, customers: DataFrame, least: int = 3, n: int = 100) -> DataFrame:
    """Customers with several complaints, most first.

    Complaints are counted per customer before the join, so the customer table
    meets one row per customer and not the fact.
    """
    counted = (
        scored.where(negative())
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("negative_feedback_count"),
            F.min("feedback_date").alias("first_complaint"),
            F.max("feedback_date").alias("latest_complaint"),
        )
        .where(F.col("negative_feedback_count") >= least)
    )
    return (
        customers.select("customer_id", "tier", "lifetime_value")
        .join(counted, "customer_id")
        .orderBy(
            F.col("negative_feedback_count").desc(), F.col("lifetime_value").desc_nulls_first(), "customer_id"
        )
        .limit(n)
    )


#: What the history of one customer shows, for a table stored by customer (``facts.write_by_key``).
HISTORY_COLUMNS = (
    "customer_id", "feedback_id", "feedback_date", "channel", "theme_label_primary", "predicted_sentiment",
    "priority_tier", "priority_score",
)


def customer_360(scored: DataFrame, customer_id: object) -> DataFrame:
    """Everything one customer has sent, latest first; the id is a bound parameter."""
    return scored.sparkSession.sql(
        """
        SELECT feedback_id, feedback_date, channel, theme_label_primary,
               predicted_sentiment, priority_tier, priority_score
        FROM {scored}
        WHERE customer_id = :customer_id
        ORDER BY feedback_date DESC, feedback_id
        """,
        args={"customer_id": customer_id},
        scored=scored,
    )


def channel_performance(scored: DataFrame) -> DataFrame:
    """Volume, negative rate, mean score and critical messages per channel."""
    return (
        scored.groupBy("channel")
        .agg(
            F.count(F.lit(1)).alias("total_feedback"),
            half_away(F.coalesce(F.count_if(negative()), F.lit(0)) / F.count(F.lit(1)).cast("double"), 3).alias("negative_rate"),
            half_away(exact_mean(F.col("priority_score")), 1).alias("avg_priority_score"),
            count_where(F.col("priority_tier") == "Critical").alias("critical_count"),
        )
        .orderBy(F.col("avg_priority_score").desc(), "channel")
    )


def sentiment_churn(scored: DataFrame) -> DataFrame:
    """Mean churn-risk proxy per sentiment: an association, not an effect."""
    return (
        scored.groupBy("predicted_sentiment")
        .agg(
            half_away(exact_mean(F.col("churn_risk_score")), 3).alias("avg_churn_risk_score"),
            F.count(F.lit(1)).alias("n"),
        )
        .orderBy(F.col("avg_churn_risk_score").desc(), "predicted_sentiment")
    )


def repeat_gap_days(scored: DataFrame) -> DataFrame:
    """Mean days between one complaint and the next of a customer on one theme.

    The gaps of a (customer, theme) series add up to its last day minus its
    first, and there is one less of them than complaints. So two aggregations
    replace a window over each customer's rows, and a customer with any number
    of complaints is merged map-side.
    """
    series = (
        scored.where(negative())
        .groupBy("customer_id", "theme_label_primary")
        .agg(
            (F.count("feedback_date") - 1).alias("gaps"),
            F.date_diff(F.max("feedback_date"), F.min("feedback_date")).cast("long").alias("days"),
        )
        .where(F.col("gaps") > 0)
    )
    return (
        series.groupBy("theme_label_primary")
        .agg(
            F.sum("gaps").alias("repeat_events"),
            half_away(F.sum("days").cast("double") / F.sum("gaps"), 1).alias("avg_days_between_repeat_complaints"),
        )
        .orderBy(F.col("repeat_events").desc(), F.asc_nulls_last("theme_label_primary"))
    )


def theme_share_recent(daily: DataFrame, days: int = 45) -> DataFrame:
    """The last ``days`` days of the daily theme table."""
    return (
        from_day(daily, F.date_sub(last_day(daily), days))
        .select("feedback_date", "theme", "theme_label", "theme_share", "theme_count", "total_feedback")
        .orderBy("theme", "feedback_date")
    )
