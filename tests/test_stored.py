"""Stored layouts: what is read of them, and what is counted while they are written."""

import re

import pytest
from pyspark.sql import functions as F

from earshot.checks import queries as q
from earshot.checks import tables as t
from earshot.operators import quality
from earshot.plans import marts, reports
from earshot.session import scratch_dir
from earshot.sources import facts

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    path = scratch_dir(spark, "scored")
    q.scored(spark, SF).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def stored(spark, scored):
    return facts.write_by_month(scored, scratch_dir(spark, "by-month"))


def scans(df):
    """(table scans of the executed plan with their metrics), after running it."""
    df.collect()
    jvm = df.sparkSession._jvm
    found, plans = [], [df._jdf.queryExecution().executedPlan()]
    while plans:
        plan = plans.pop()
        if plan.nodeName() == "AdaptiveSparkPlan":
            plan = plan.executedPlan()
        plans += [plan.subqueriesAll().apply(i) for i in range(plan.subqueriesAll().size())]
        leaves = plan.collectLeaves()
        for i in range(leaves.size()):
            leaf = leaves.apply(i)
            if "QueryStage" in leaf.nodeName() or leaf.nodeName() == "AdaptiveSparkPlan":
                plans.append(leaf.plan() if "QueryStage" in leaf.nodeName() else leaf)
            elif leaf.nodeName().startswith("Scan parquet"):
                rows = leaf.metrics().apply("numOutputRows").value()
                found.append((str(leaf.toString()), rows))
    assert jvm is not None and found
    return found


def test_months_hold_all_rows_and_null_days(spark, scored, stored):
    assert stored.columns == [*scored.columns, facts.MONTH] and stored.count() == scored.count()
    days = spark.createDataFrame([(1, "2024-01-31"), (2, "2024-02-01"), (3, None)], "id long, day string")
    days = days.select("id", F.to_date("day").alias("day"))
    back = facts.write_by_month(days, scratch_dir(spark, "days"), "day")
    assert {r["id"]: r[facts.MONTH] for r in back.collect()} == {1: "2024-01", 2: "2024-02", 3: None}
    assert facts.from_day(back, F.lit("2024-02-01").cast("date"), "day").count() == 1


@pytest.mark.parametrize("report", [
    lambda fact: reports.worsening_products(fact, t.products(fact.sparkSession, SF), by="category", least=10),
    lambda fact: reports.theme_share_recent(fact.withColumns(
        {"theme": F.lit(""), "theme_label": F.lit(""), "theme_share": F.lit(0.0), "theme_count": F.lit(0), "total_feedback": F.lit(0)})),
    lambda fact: marts.executive(fact),
])
def test_reports_agree_and_prune_months(scored, stored, report):
    old, new = report(scored), report(stored)
    assert sorted(map(str, old.collect())) == sorted(map(str, new.collect()))
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert re.search(rf"PartitionFilters: \[[^\]]*{facts.MONTH}", plan), plan


def test_a_bounded_period_reads_few_rows(stored):
    n = stored.count()
    report = reports.worsening_products(stored, t.products(stored.sparkSession, SF), by="category", least=10)
    read = [rows for text, rows in scans(report) if facts.MONTH in text and "product_id" in text]
    assert read and max(read) < n / 8  # seven of eighty months


def test_a_lookup_reads_a_small_share(spark, scored):
    many = scored.select(*reports.HISTORY_COLUMNS).crossJoin(spark.range(20).drop("id")).withColumn(
        "customer_id", F.when(F.rand(3) < 0.33, F.lit(-1).cast("long")).otherwise(F.col("customer_id"))
    )
    path = scratch_dir(spark, "by-customer")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small ranges would be merged
    try:
        history = facts.write_by_key(many, path, "customer_id", ("feedback_date", "feedback_id"), row_group_bytes=256 << 10)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    n = history.count()
    assert n == 20 * scored.count()
    for customer in (7, 700):
        rows = sum(rows for _, rows in scans(reports.customer_360(history, customer)))
        assert 0 < rows < n / 20, rows
    files = history.where("customer_id = -1").select(F.input_file_name()).distinct().count()
    assert files > 1  # a customer with a third of the rows is spread
    assert reports.customer_360(history, 10**9).count() == 0


def test_lookups_by_text_ids(spark):
    rows = spark.range(5000).select(F.concat(F.lit("C"), F.col("id") % 500).alias("key"), F.col("id").alias("n"))
    back = facts.write_by_key(rows, scratch_dir(spark, "text-keys"), "key", ("n",))
    assert back.where("key = 'C17'").count() == 10 and back.count() == 5000


def test_counts_come_from_the_write(spark, scored):
    calls = []

    def write(df):
        calls.append(1)
        return facts.write_by_month(df, scratch_dir(spark, "counted"))

    stored, counts = quality.written_with(facts.by_month(scored), write, "seen", **quality.tier_columns())
    want = {r["priority_tier"]: r["count"] for r in scored.groupBy("priority_tier").count().collect()}
    assert len(calls) == 1 and counts.pop("rows") == scored.count() == stored.count()
    assert {k: n for k, n in counts.items() if n} == want


def test_checks_fail_where_something_is_amiss(spark):
    lost = spark.createDataFrame([("k", 0, 3, 1)], "key_name string, null_rows long, orphan_rows long, orphan_keys long")
    checks = quality.fact_checks(10, {"rows": 9, "Critical": 4, "Low": 4}, lost)
    assert [(c.name, c.expected, c.actual, c.ok) for c in checks] == [("rows", 10, 9, False), ("tiers", 9, 8, False), ("orphans k", 0, 3, False)]
    good = quality.fact_checks(9, {"rows": 9, "Critical": 5, "Low": 4}, lost.where("orphan_rows = 0"))
    assert quality.check_table(spark, good).where("NOT ok").count() == 0
    empty, counts = quality.written_with(lost.limit(0), lambda df: facts.write_by_key(df, scratch_dir(spark, "none"), "key_name"), "none", x=F.count("orphan_rows"))
    assert counts == {"rows": 0, "x": 0} and empty.count() == 0
