"""What the plans look like: pruned scans, no products, no Python in the hot path."""

import re

import pytest
from pyspark.sql import functions as F

from earshot.checks import queries as q
from earshot.checks import tables as t
from earshot.operators.priority import score_feedback
from earshot.plans import reports

SF = "/root/testdata/sf0.001"
FITTED = {
    "tfidf_features", "sentiment_logreg", "sentiment_svm", "sentiment_champion", "topics_nmf", "topics_lda",
    "lsa_embedding", "topic_top_terms", "topics_champion", "topics_kmeans", "stream_theme_counts", "kmeans_given_start",
}


def plan(df):
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def scans(df):
    return [
        set(re.findall(r"(\w+):", m)) for m in re.findall(r"ReadSchema: struct<([^>]*)>", plan(df))
    ]


@pytest.mark.parametrize("name", sorted(set(q.QUERIES) - FITTED))
def test_no_products_and_no_python(spark, name):
    text = plan(q.QUERIES[name](spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "MapInArrow", "FlatMapGroups"):
        assert node not in text, node


def test_scans_read_only_what_is_used(spark):
    assert scans(q.QUERIES["sentiment_trend_month"](spark, SF)) == [{"o_orderstatus", "o_orderdate"}]
    assert scans(q.QUERIES["lexicon_hits"](spark, SF)) == [{"doc_id", "text"}]
    fields = set().union(*scans(q.QUERIES["theme_daily_share"](spark, SF)))
    assert fields == {"o_orderkey", "o_orderdate", "l_orderkey", "l_partkey", "p_partkey", "p_type"}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "scored")
    q.scored(spark, SF).write.parquet(path)
    return spark.read.parquet(path)


def test_filters_reach_the_stored_table(stored):
    text = plan(reports.customer_360(stored, 7))
    assert "EqualTo(customer_id,7)" in text
    assert "EqualTo(predicted_sentiment,negative)" in plan(reports.complaint_mix(stored))
    assert scans(reports.complaint_mix(stored)) == [{"theme_label_primary", "channel", "predicted_sentiment"}]


def test_reports_read_the_stored_table_once(stored):
    once = [reports.sentiment_trend_month, reports.complaint_mix, reports.channel_performance, reports.repeat_gap_days]
    for report in once:
        assert plan(report(stored)).count("FileScan parquet") == 1


def test_scoring_shuffles_the_fact_once(spark, tmp_path):
    """With every join on the shuffle path, the wide fact rows still move once."""
    path = str(tmp_path / "fb")
    t.feedback(spark, SF).withColumn("payload", F.lit("x")).write.parquet(path)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scored = score_feedback(spark.read.parquet(path), t.customers(spark, SF), t.THEMES)
        lines = plan(scored).split("\n")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # exchanges whose subtree starts with rows that still carry the payload column
    wide = [
        i for i, line in enumerate(lines)
        if "Exchange hashpartitioning" in line and "payload" in lines[i + 1]
    ]
    assert len(wide) == 1


def test_topic_rows_are_made_where_the_text_is_read(spark):
    data = q._corpus(spark, SF)
    rows = data.rows
    text = plan(rows)
    data.release()
    assert "MapInArrow" in text and "Exchange" not in text, text
