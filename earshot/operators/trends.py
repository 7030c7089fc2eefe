"""Daily theme shares, rolling baselines and emerging-issue alerts."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.catalogue import ALERT_MESSAGE
from earshot.functions.labels import label_or_code
from earshot.functions.numbers import half_even, ratio


@dataclass(frozen=True)
class Baseline:
    """Which rows of a theme's series are compared with which."""

    recent: int = 7          # trailing rows under test
    length: int = 30         # baseline rows that end where the recent ones begin
    least: int = 14          # baseline rows that must be present


@dataclass(frozen=True)
class AlertRule:
    """When the latest point of a series counts as an emerging issue."""

    z: float = 3.0
    change: float = 1.0
    critical_z: float = 6.0
    min_recent_count: int = 0


def theme_marks(themes: str) -> Column:
    """One (is_total, theme) entry for the message itself and one for each of its themes."""
    listed = F.coalesce(F.col(themes), F.array().cast("array<string>"))
    return F.concat(
        F.array(F.struct(F.lit(True).alias("is_total"), F.lit(None).cast("string").alias("theme"))),
        F.transform(listed, lambda t: F.struct(F.lit(False).alias("is_total"), t.alias("theme"))),
    )


def shares_of_counts(counted: DataFrame) -> DataFrame:
    """Shares from (feedback_date, is_total, theme, theme_count), one row per day and theme and one per day."""
    one_day = Window.partitionBy("feedback_date")
    total = F.max(F.when(F.col("is_total"), F.col("theme_count"))).over(one_day)
    return (
        counted.withColumn("total_feedback", total)
        .where(~F.col("is_total") & F.col("theme").isNotNull() & F.col("feedback_date").isNotNull())
        .select(
            "feedback_date", "theme", "theme_count", "total_feedback",
            ratio(F.col("theme_count"), F.col("total_feedback")).alias("theme_share"),
        )
    )


def theme_daily_share(
    messages: DataFrame, day: Column, themes: str = "inferred_themes"
) -> DataFrame:
    """(feedback_date, theme, theme_count, total_feedback, theme_share).

    One pass and one shuffle: each message adds one total row besides its theme
    rows, so the denominator needs no second scan and no join of the fact.
    """
    counted = (
        messages.select(day.alias("feedback_date"), F.explode(theme_marks(themes)).alias("m"))
        .groupBy("feedback_date", "m.is_total", "m.theme")
        .agg(F.count(F.lit(1)).alias("theme_count"))
    )
    return shares_of_counts(counted)


def densify(series: DataFrame, key: str, at: str, step: str, fills: Mapping[str, object]) -> DataFrame:
    """Every step from a key's first to its last row; absent rows take the fills.

    ``series`` is an aggregate with one row per key and step, so it is bounded
    by keys x calendar, whatever the size of the fact.
    """
    span = series.groupBy(key).agg(F.min(at).alias("_from"), F.max(at).alias("_to"))
    grid = span.select(key, F.explode(F.sequence("_from", "_to", F.expr(step))).alias(at))
    full = grid.join(series, [key, at], "left")
    return full.select(key, at, *[F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in fills.items()])


def rolling_metrics(
    series: DataFrame, key: str, at: str, share: str, baseline: Baseline = Baseline(),
    count: str | None = None,
) -> DataFrame:
    """Adds baseline mean and deviation, recent mean, z-score and relative change."""
    ordered = Window.partitionBy(key).orderBy(at)
    before = ordered.rowsBetween(-(baseline.recent + baseline.length - 1), -baseline.recent)
    recent = ordered.rowsBetween(-(baseline.recent - 1), 0)
    enough = F.count(share).over(before) >= baseline.least
    full = F.count(share).over(recent) == baseline.recent
    out = series.select(
        "*",
        F.when(enough, F.avg(share).over(before)).alias("baseline_mean"),
        F.when(enough, F.stddev_samp(share).over(before)).alias("baseline_std"),
        F.when(full, F.avg(share).over(recent)).alias("recent_avg"),
        *([F.when(full, F.sum(count).over(recent)).alias("recent_count")] if count else []),
    )
    rise = F.col("recent_avg") - F.col("baseline_mean")
    return out.withColumn("z_score", ratio(rise, F.col("baseline_std"))).withColumn(
        "change", ratio(rise, F.col("baseline_mean"))
    )


def emerging_daily(daily: DataFrame, baseline: Baseline = Baseline()) -> DataFrame:
    """Spike metrics for every theme and day of :func:`theme_daily_share`."""
    dense = densify(
        daily, "theme", "feedback_date", "interval 1 day", {"theme_share": 0.0, "theme_count": 0}
    )
    return rolling_metrics(dense, "theme", "feedback_date", "theme_share", baseline, "theme_count")


def flagged(rule: AlertRule) -> Column:
    test = (F.col("z_score") > rule.z) & (F.col("change") > rule.change)
    if rule.min_recent_count:
        test = test & (F.col("recent_count") >= rule.min_recent_count)
    return F.coalesce(test, F.lit(False))


def latest_per_theme(metrics: DataFrame, as_of: str = "theme_last") -> DataFrame:
    """Last row of each theme.

    ``theme_last`` takes a theme's own last day; ``table_max`` drops themes that
    have been silent since before the last day of the table.
    """
    columns = [c for c in metrics.columns if c != "theme"]
    last = metrics.groupBy("theme").agg(
        F.max_by(F.struct(*columns), F.col("feedback_date")).alias("_row")
    )
    last = last.select("theme", "_row.*")
    if as_of == "table_max":
        return last.where(F.col("feedback_date") == metrics.agg(F.max("feedback_date")).scalar())
    if as_of != "theme_last":
        raise ValueError(f"as_of must be theme_last or table_max, not {as_of!r}")
    return last


def alerts(
    metrics: DataFrame,
    labels: Mapping[str, str],
    rule: AlertRule = AlertRule(),
    as_of: str = "theme_last",
    template: str = ALERT_MESSAGE,
) -> DataFrame:
    """The alert list: one row per theme whose latest point breaks the rule."""
    hit = latest_per_theme(metrics, as_of).where(flagged(rule))
    theme = label_or_code(F.col("theme"), labels)
    base, recent = F.col("baseline_mean") * 100, F.col("recent_avg") * 100
    change, z = F.col("change") * 100, F.col("z_score")
    message = F.format_string(
        template,
        theme, half_even(base, 2), half_even(recent, 2), half_even(change, 0), half_even(z, 1),
    )
    return hit.select(
        theme.alias("theme"),
        half_even(base, 2).alias("baseline_share_pct"),
        half_even(recent, 2).alias("recent_7d_share_pct"),
        half_even(change, 1).alias("pct_change"),
        half_even(z, 2).alias("z_score"),
        F.when(z > rule.critical_z, "Critical").otherwise("High").alias("severity"),
        message.alias("message"),
    ).orderBy(F.col("z_score").desc(), "theme")


def rate_split(messages: DataFrame, theme: str, day: Column, cutoff: Column, themes: str = "inferred_themes") -> DataFrame:
    """One row: a theme's rate after the cutoff day against up to and including it."""
    has = F.coalesce(F.array_contains(themes, theme), F.lit(False))
    rows = messages.select(has.alias("has"), F.coalesce(day > cutoff, F.lit(False)).alias("late"))
    return rows.agg(
        F.lit(theme).alias("theme"),
        F.count_if("late").alias("n_after"),
        F.count_if(F.col("late") & F.col("has")).alias("hits_after"),
        F.count_if(~F.col("late")).alias("n_before"),
        F.count_if(~F.col("late") & F.col("has")).alias("hits_before"),
    ).select(
        "*",
        ratio(F.col("hits_after"), F.col("n_after")).alias("rate_after"),
        ratio(F.col("hits_before"), F.col("n_before")).alias("rate_before"),
    )
