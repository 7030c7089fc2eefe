import datetime as dt

import pytest
from pyspark.sql import functions as F

from earshot.functions.labels import label_or_code, lookup
from earshot.operators import agreement, quality
from earshot.plans import marts, reports

D = dt.date(2025, 12, 31)
SCORED = (
    "feedback_id int, customer_id string, product_id string, channel string, feedback_date date, "
    "predicted_sentiment string, sentiment_confidence double, theme_label_primary string, priority_score double, "
    "priority_tier string, churn_risk_score double, tier string, lifetime_value double"
)


def row(i, **kw):
    base = dict(
        feedback_id=i, customer_id="a", product_id="p", channel="chat", feedback_date=D, predicted_sentiment="negative",
        sentiment_confidence=0.9, theme_label_primary="T", priority_score=50.0, priority_tier="High",
        churn_risk_score=0.3, tier="Gold", lifetime_value=1.0,
    )
    base.update(kw)
    return tuple(base.values())


def scored(spark, *rows):
    return spark.createDataFrame(list(rows), SCORED)


def test_period_borders(spark):
    """Recent: the last day back to day -90 inclusive. Prior: day -91 to day -180."""
    days = [0, 90, 91, 180, 181]
    rows = [row(i, feedback_date=D - dt.timedelta(days=d)) for i, d in enumerate(days)]
    products = spark.createDataFrame([("p", "c")], "product_id string, category string")
    got = reports.worsening_products(scored(spark, *rows), products, least=1).first()
    assert got.n_recent == 2 and got.neg_rate_recent == 1.0 and got.neg_rate_prior == 1.0


def test_worsening_products_by_product(spark):
    rows = [row(i, product_id=p, predicted_sentiment=s, feedback_date=D - dt.timedelta(days=d))
            for i, (p, s, d) in enumerate([
                ("p", "negative", 0), ("p", "positive", 100), ("q", "positive", 1), ("q", "negative", 100),
                ("unknown", "negative", 0), ("unknown", "positive", 100), ("new", "negative", 0)])]
    products = spark.createDataFrame([("p", "c"), ("q", "c"), ("new", "c")], "product_id string, category string")
    got = reports.worsening_products(scored(spark, *rows), products, least=1).collect()
    assert [(r.product_id, r.pct_point_change) for r in got] == [("p", 1.0), ("q", -1.0)]


def test_last_30_days_exclude_the_border(spark):
    rows = [row(i, feedback_date=D - dt.timedelta(days=d)) for i, d in enumerate([0, 29, 30, 31])]
    assert marts.executive(scored(spark, *rows)).first().last_30d_feedback_volume == 2


def test_executive(spark):
    rows = [
        row(1, theme_label_primary="B", churn_risk_score=0.6), row(2, theme_label_primary="A", churn_risk_score=0.6),
        row(3, predicted_sentiment="positive", priority_tier="Critical", customer_id="b", theme_label_primary=None),
        row(4, predicted_sentiment="neutral", priority_tier="Low", theme_label_primary=None),
    ]
    got = marts.executive(scored(spark, *rows)).first()
    assert got.total_feedback == 4 and got.negative_sentiment_pct == 50.0 and got.csat_proxy_pct == 25.0
    assert got.critical_complaints_count == 1 and got.resolution_rate_proxy_pct == 25.0
    assert got.top_complaint_topic == "A"  # tied: the smaller label
    assert got.at_risk_customers_count == 1 and got.emerging_issues_count == 0 and got.as_of_date == D


def test_unknown_keys_have_no_page_entry(spark):
    rows = [
        row(1), row(2, theme_label_primary=None), row(3, product_id="lost"), row(4, product_id=None),
        row(5, customer_id="x", tier=None, lifetime_value=None),
    ]
    df = scored(spark, *rows)
    products = spark.createDataFrame([("p", "c", "normal")], "product_id string, category string, quality_risk string")
    assert [(r.theme_label_primary, r.volume) for r in marts.topic(df).collect()] == [("T", 4)]
    assert [(r.product_id, r.feedback_volume) for r in marts.product(df, products).collect()] == [("p", 3)]
    assert [(r.customer_id, r.feedback_count) for r in marts.customer_risk(df).collect()] == [("a", 4)]


def test_means_ignore_missing_scores(spark):
    df = scored(spark, row(1, priority_score=10.1), row(2, priority_score=None), row(3, priority_score=20.2))
    assert marts.channel(df).first().avg_priority_score == pytest.approx(15.15, abs=1e-12)


def test_gap_days_equal_a_lag(spark):
    import random

    rng = random.Random(3)
    rows = [
        row(i, customer_id=rng.choice(["a", "b", "c", None]), theme_label_primary=rng.choice(["S", "T", None]),
            predicted_sentiment=rng.choice(["negative", "positive"]), feedback_date=D - dt.timedelta(days=rng.randrange(300)))
        for i in range(200)
    ]
    got = {r.theme_label_primary: tuple(r)[1:] for r in reports.repeat_gap_days(scored(spark, *rows)).collect()}
    gaps = {}
    for key in {(r[1], r[7]) for r in rows}:
        days = sorted(r[4] for r in rows if (r[1], r[7]) == key and r[5] == "negative")
        gaps.setdefault(key[1], []).extend((b - a).days for a, b in zip(days, days[1:]))
    assert got.keys() == gaps.keys()
    for theme, values in gaps.items():
        assert got[theme][0] == len(values)
        assert got[theme][1] == pytest.approx(sum(values) / len(values), abs=0.0501)


def test_customer_360_binds_its_parameter(spark):
    df = scored(spark, row(1, customer_id="a' OR '1'='1"), row(2), row(3, feedback_date=D - dt.timedelta(days=1)))
    assert [r.feedback_id for r in reports.customer_360(df, "a").collect()] == [2, 3]
    assert [r.feedback_id for r in reports.customer_360(df, "a' OR '1'='1").collect()] == [1]


def test_two_rules_for_missing_labels(spark):
    df = spark.createDataFrame([("x",), ("y",), (None,)], "k string")
    labels = {"x": "X"}
    got = df.select(lookup(F.col("k"), labels), label_or_code(F.col("k"), labels)).collect()
    assert [tuple(r) for r in got] == [("X", "X"), (None, "y"), (None, None)]


def test_majority_ties_and_purity(spark):
    pairs = [(0, "b"), (0, "a"), (1, "c"), (1, "c"), (1, "a"), (2, None), (2, None), (2, "z")]
    df = spark.createDataFrame(pairs, "cluster int, truth string")
    got = {r.cluster: (r.n, r.majority, r.hits) for r in agreement.cluster_majority(df, "cluster", "truth").collect()}
    assert got == {0: (2, "a", 1), 1: (3, "c", 2), 2: (3, "z", 1)}
    assert agreement.purity(df, "cluster", "truth").first().purity == 4 / 8


def test_report_of_a_class_nobody_predicts(spark):
    df = spark.createDataFrame(
        [("negative", "negative"), ("negative", "positive"), ("neutral", "negative"), ("positive", "positive")],
        "truth string, predicted string",
    )
    matrix = agreement.confusion_matrix(df, "truth", "predicted")
    assert matrix.count() == 9 and matrix.agg(F.sum("n")).first()[0] == 4
    got = {r.label: r for r in agreement.classification_report(matrix).collect()}
    assert (got["neutral"].precision, got["neutral"].recall, got["neutral"].f1, got["neutral"].support) == (0, 0, 0, 1)
    assert (got["negative"].precision, got["negative"].recall) == (0.5, 0.5)
    assert got["macro avg"].f1 == pytest.approx((0.5 + 0 + 2 / 3) / 3)
    assert got["accuracy"].f1 == 0.5 and got["weighted avg"].recall == 0.5


def test_orphans(spark):
    fact = spark.createDataFrame([("a",), ("a",), ("x",), ("x",), ("y",), (None,)], "customer_id string")
    got = quality.orphans(fact, {"customer_id": spark.createDataFrame([("a",)], "customer_id string")}).first()
    assert (got.null_rows, got.orphan_rows, got.orphan_keys) == (1, 3, 2)


def test_truth_leak_is_found(spark, tmp_path):
    path = str(tmp_path / "fb")
    spark.createDataFrame([("t", 1)], "true_themes string, n int").write.parquet(path)
    df = spark.read.parquet(path)
    quality.assert_no_truth(df.groupBy("n").count())
    with pytest.raises(ValueError, match="true_themes"):
        quality.assert_no_truth(df.where("true_themes = 't'").select("n"))
    last = df.agg(F.max("true_themes")).scalar()
    with pytest.raises(ValueError, match="true_themes"):
        quality.assert_no_truth(df.select("n", last.alias("last")))
