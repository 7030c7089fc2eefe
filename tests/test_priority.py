import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from earshot import catalogue as c
from earshot.operators import priority
from earshot.operators.history import customer_days, id_ranges, prior_complaints
from earshot.operators.ranking import percentile_of_value, stratified_split

FEEDBACK = (
    "feedback_id string, customer_id string, feedback_date date, predicted_sentiment string, "
    "sentiment_confidence double, inferred_themes array<string>"
)
CUSTOMERS = "customer_id string, lifetime_value double, tier string, base_churn_prob double"
D = dt.date(2025, 3, 1)


def random_feedback(n, seed, hot_share=0.0):
    """Rows of which ``hot_share`` belong to one customer on one day."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = rng.random() < hot_share
        rows.append((
            f"F{i:05d}",
            "C0" if hot else rng.choice([None, *(f"C{k}" for k in range(12))]),
            D if hot else rng.choice([None, *(D + dt.timedelta(days=k) for k in range(-5, 6))]),
            rng.choice(["negative", "neutral", "positive", None]), 0.5, ["pricing"],
        ))
    return rows


def brute_force(rows, order=lambda r: r[0]):
    want = {}
    for r in rows:
        if r[1] is None:
            want[r[0]] = None
            continue
        key = (r[2] or dt.date.max, order(r))
        want[r[0]] = sum(
            o[1] == r[1] and o[3] == "negative" and (o[2] or dt.date.max, order(o)) < key for o in rows
        )
    return want


def counts(df):
    return {r.feedback_id: r.repeat_negative_count for r in df.collect()}


def test_prior_complaints_equal_brute_force(spark):
    rows = random_feedback(400, 1)
    assert counts(prior_complaints(spark.createDataFrame(rows, FEEDBACK))) == brute_force(rows)


@pytest.mark.parametrize("hot_day", [1, 10, 40, 1_000_000])
@pytest.mark.parametrize("numeric", [False, True])
def test_hot_customer_days_keep_the_order_of_ids(spark, hot_day, numeric):
    rows = random_feedback(600, 2, hot_share=0.35)
    schema = FEEDBACK
    if numeric:
        rows = [(int(r[0][1:]), *r[1:]) for r in rows]
        schema = schema.replace("feedback_id string", "feedback_id long")
    df = spark.createDataFrame(rows, schema)
    assert counts(prior_complaints(df, hot_day=hot_day)) == brute_force(rows)


def test_hot_days_are_cut_into_ranges(spark):
    rows = random_feedback(600, 2, hot_share=0.35)
    df = spark.createDataFrame(rows, FEEDBACK).where("customer_id is not null")
    hot = customer_days(df).where("messages > 40").select("customer_id", "feedback_date")
    cuts = id_ranges(df, hot, "customer_id", "feedback_date", "feedback_id", 40).collect()
    assert len(cuts) == 1 and len(cuts[0]["_cuts"]) >= 3 and cuts[0]["_cuts"] == sorted(cuts[0]["_cuts"])


def test_one_customer_with_a_third_of_all_rows(spark):
    """No task gets the customer as a whole: the fact is spread over its days."""
    rows = spark.range(60_000).select(
        F.col("id").alias("feedback_id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("customer_id"),
        F.date_add(F.lit(D), (F.col("id") % 400).cast("int")).alias("feedback_date"),
        F.lit("negative").alias("predicted_sentiment"),
    )
    out = prior_complaints(rows)
    hot = out.where("customer_id = 0")
    assert hot.agg(F.max("repeat_negative_count")).first()[0] == 19_999
    assert hot.select("repeat_negative_count").distinct().count() == 20_000
    assert out.where("customer_id <> 0 and repeat_negative_count > 0").count() == 0
    with_adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in prior_complaints(rows).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", with_adaptive)
    assert max(sizes) < 60_000 * 0.25


@pytest.mark.parametrize("slices", [1, 3, 128])
def test_percentile_equals_pandas(spark, slices):
    rng = np.random.default_rng(5)
    values = np.concatenate([np.round(rng.lognormal(3, 2, 300), 1), np.full(200, 7.5), [0.0, -3.0, 1e9]])
    pdf = pd.DataFrame({"v": values, "w": rng.integers(1, 5, len(values))})
    df = spark.createDataFrame(pdf).union(spark.createDataFrame([(None, 4)], "v double, w long"))
    want = pd.Series(np.repeat(pdf.v, pdf.w)).rank(pct=True)
    want = dict(zip(np.repeat(pdf.v, pdf.w), want))
    got = {r.v: r.percentile for r in percentile_of_value(df, "v", "w", slices).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_percentile_is_ranked_over_messages_not_customers(spark):
    people = spark.createDataFrame(
        [("a", 10.0, "Gold", 0.1), ("b", 20.0, "Gold", 0.1), ("c", None, "Gold", 0.1), ("idle", 15.0, "Gold", 0.1)], CUSTOMERS
    )
    rows = [("1", "a"), ("2", "a"), ("3", "a"), ("4", "b"), ("5", "c"), ("6", "zzz")]
    df = spark.createDataFrame(rows, "feedback_id string, customer_id string")
    got = {r.customer_id: r.customer_value_score for r in priority.customer_profile(df, people).collect()}
    assert got["a"] == 0.5 and got["b"] == 1.0 and got["c"] is None


@pytest.mark.parametrize("n", [0, 1, 2, 3, 1003])
def test_split_is_exact_per_label(spark, n):
    df = spark.range(n).select("id", F.when(F.col("id") % 10 == 0, "x").when(F.col("id") % 3 == 0, None).otherwise("y").alias("label"))
    got = stratified_split(df, "label", "id", 0.2)
    assert got.count() == n
    for r in got.groupBy("label").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect():
        assert r.t == math.floor(0.2 * r.n + 0.5)
    assert sorted(map(tuple, got.collect())) if n and n < 3 else True
    again = stratified_split(df, "label", "id", 0.2)
    assert got.exceptAll(again).count() == 0


def test_split_equals_ranking_by_key(spark):
    df = spark.range(5000).select("id", (F.col("id") % 3).cast("string").alias("label"))
    key = F.xxhash64(F.lit(42), F.col("id"))
    got = {r.id for r in stratified_split(df, "label", "id", 0.3).where("is_test").select("id").collect()}
    want = set()
    rows = df.select("id", "label", key.alias("k")).collect()
    for label in "012":
        ranked = sorted((r.k, r.id) for r in rows if r.label == label)
        want |= {i for _, i in ranked[: math.floor(0.3 * len(ranked) + 0.5)]}
    assert got == want


def make_scored(spark, rows, people, active=None):
    feedback = spark.createDataFrame(rows, FEEDBACK)
    customers = spark.createDataFrame(people, CUSTOMERS)
    labels = None if active is None else spark.createDataFrame([(a,) for a in active], "theme string")
    return priority.score_feedback(feedback, customers, active=labels)


PEOPLE = [("a", 100.0, "Gold", 0.10), ("b", 300.0, "Bronze", 0.28), ("r", 50.0, "Bronze", 0.9)]


def test_score_by_hand(spark):
    rows = [
        ("1", "a", D, "negative", 0.9, ["payment_double_charge", "pricing"]),
        ("2", "a", D, "negative", 1.0, ["delivery_delay"]),
        ("3", "b", D, "positive", 1.0, ["unclassified"]),
        ("4", "zzz", D, "negative", 1.0, ["pricing"]),
        ("5", "r", D, "negative", 1.0, ["pricing"]),
    ]
    got = {r.feedback_id: r for r in make_scored(spark, rows, PEOPLE, ["Payment Issues (Double Charge)"]).collect()}
    first = got["1"]
    # values known for 4 rows: 50 -> rank 1, 100 -> ranks 2 and 3, 300 -> rank 4
    assert first.customer_value_score == 2.5 / 4
    assert first.issue_growth_score == 1.0 and got["2"].issue_growth_score == 0.0
    want = 100 * (0.25 * 0.9 + 0.20 * 0.95 + 0.15 * 0.625 + 0.15 * 0.15 + 0.15 * 1.0 + 0.10 * 0.0)
    assert first.priority_score == round(want, 1) and first.priority_tier == "Critical"
    assert got["2"].repeat_negative_count == 1
    assert abs(got["2"].repeat_complaint_score - math.tanh(1 / 3)) < 1e-15
    # unknown theme: default severity, no label, no growth
    assert got["3"].theme_severity == 0.4 and got["3"].theme_label_primary is None
    assert got["3"].issue_growth_score == 0.0 and got["3"].sentiment_severity_score == 0.0
    # unknown customer: no score, lowest tier
    assert got["4"].priority_score is None and got["4"].priority_tier == "Low"
    # churn is clipped at one, and a missing one stays missing
    assert got["5"].churn_risk_score == 1.0 and got["4"].churn_risk_score is None


def test_tier_reads_the_rounded_score(spark):
    df = spark.createDataFrame([(0.24949,), (0.24951,), (0.6495,), (0.64949,)], "x double")
    names = {n: F.col("x") if i == 0 else F.lit(0.0) for i, n in enumerate(c.PRIORITY_WEIGHTS)}
    weights = {n: 1.0 for n in c.PRIORITY_WEIGHTS}
    out = df.withColumns(names).withColumn("s", priority.priority_score(weights))
    assert [r.s for r in out.collect()] == [24.9, 25.0, 65.0, 64.9]


def test_rounding_is_half_to_even_after_scaling(spark):
    from earshot.functions.numbers import half_away, half_even

    xs = [0.125, 1.005, 2.675, 0.25, -0.25, 0.35, 12.345]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for digits in (1, 2):
        got = [r[0] for r in df.select(half_even(F.col("x"), digits)).collect()]
        assert got == [float(np.round(x, digits)) for x in xs]
    assert [r[0] for r in df.select(half_away(F.col("x"), 2)).collect()][0] == 0.13


def test_cards(spark):
    rows = [(f"{i:03d}", "a", D + dt.timedelta(days=i), "negative", 0.625 + i / 1000, ["pricing", "packaging", "odd"]) for i in range(40)]
    scored = make_scored(spark, rows, PEOPLE, ["Pricing"])
    cards = priority.explanation_cards(scored).collect()
    assert len(cards) == 25
    scores = [r.priority_score for r in cards]
    assert scores == sorted(scores, reverse=True)
    assert all(r.severity == r.recommended_priority and r.part_of_emerging_issue for r in cards)
    assert cards[0].secondary_issues == ["Packaging", "odd"]
    assert cards[0].primary_issue == "Pricing" and cards[0].customer_value == "Gold"
    # rows 036 to 039 share the highest rounded score: the smaller id comes first
    assert cards[0].feedback_id == "036" and cards[0].repeat_complaints_before_this == 36
    assert cards[0].sentiment == "Negative — 66%"
    lone = make_scored(spark, [("1", "a", D, "positive", 0.5, ["unclassified"])], PEOPLE)
    assert priority.explanation_cards(lone).first().secondary_issues == []


def test_distribution_and_reconciliation(spark):
    scored = make_scored(spark, random_feedback(200, 9), PEOPLE + [(f"C{k}", 10.0 * k, "Gold", 0.1) for k in range(12)])
    shares = priority.distribution(scored, "priority_tier").collect()
    assert abs(sum(r.share for r in shares) - 1) < 1e-12 and sum(r.n for r in shares) == 200
    totals = priority.tier_counts(scored).first()
    assert totals.adds_up and totals.fact_rows == 200
