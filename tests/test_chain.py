"""Files in, files out: the whole job over a small planted data set."""

import csv
import datetime as dt
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from earshot import catalogue as c
from earshot.operators.features import TermRules
from earshot.plans import chain
from earshot.session import scratch_dir, side_by_side, spread
from earshot.sources import tables

START = dt.date(2025, 1, 1)
DAYS = 80


def planted(folder, n=1600):
    """Feedback from the catalogue's own phrases, with a burst of double charges at the end."""
    rng = random.Random(7)
    phrases = c.phrase_list()
    common = [p for p in phrases if p.theme != "payment_double_charge"]
    burst = [p for p in phrases if p.theme == "payment_double_charge"]
    with open(folder / "feedback.csv", "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(tables.FEEDBACK.names)
        for i in range(n):
            day = i * DAYS // n
            pool = burst if rng.random() < (0.4 if day >= DAYS - 7 else 0.02) else common
            picked = [rng.choice(pool)]
            if rng.random() < 0.3:
                picked.append(rng.choice(common))
            text = ". ".join(p.text.capitalize() for p in picked) + "."
            labels = [p.sentiment for p in picked]
            votes = [labels.count(s) for s in c.SENTIMENTS]
            overall = c.SENTIMENTS[0] if votes[0] >= max(votes[1:]) else c.SENTIMENTS[1 if votes[1] >= votes[2] else 2]
            out.writerow([
                f"F{i:05d}", f"C{rng.randrange(60)}", f"P{rng.randrange(6)}", rng.choice(["chat", "review"]),
                START + dt.timedelta(days=day), text, "|".join(p.theme for p in picked),
                "|".join(f"{p.theme}:{p.sentiment}" for p in picked), overall,
            ])
    with open(folder / "customers.csv", "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(tables.CUSTOMERS.names)
        out.writerows([f"C{k}", START, "North", rng.choice(["Gold", "Bronze"]), 10.5 * k, 0.28] for k in range(60))
    with open(folder / "products.csv", "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(tables.PRODUCTS.names)
        out.writerows([f"P{k}", f"Cat{k % 2}", 9.99, "normal"] for k in range(6))


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    data, out = tmp_path_factory.mktemp("data"), tmp_path_factory.mktemp("out")
    planted(data)
    settings = chain.Settings(
        sentiment_terms=TermRules(min_df=3, max_features=2000), topic_min_df=2, n_topics=5, embedding_rank=20
    )
    return chain.run(spark, str(data), str(out), settings), str(out)


def test_every_message_is_scored(finished):
    scored = finished[0]["scored"]
    assert scored.count() == 1600
    assert scored.where("priority_score is null or priority_tier is null").count() == 0
    assert not set(scored.columns) & {"true_themes", "true_aspect_sentiments", "true_overall_sentiment"}


def test_exactly_the_planted_issue_is_found(finished):
    alerts = finished[0]["alerts"].collect()
    assert [a.theme for a in alerts] == ["Payment Issues (Double Charge)"]
    assert alerts[0].recent_7d_share_pct > 25


def test_lexicon_beats_keywords(spark, finished):
    rows = {r.approach: r.agreement for r in spark.read.json(f"{finished[1]}/aspect_evaluation").collect()}
    assert rows["phrase_lexicon"] > 0.97 > rows["keyword_clauses"]


def test_trained_models_beat_the_rules(spark, finished):
    rows = spark.read.json(f"{finished[1]}/model_comparison").where("task = 'sentiment'").collect()
    scores = {r.method: r.score for r in rows}
    assert scores["tfidf_logreg"] > scores["rule_based"] and scores["tfidf_logreg"] > 0.95
    assert [r.method for r in rows if r.chosen] == [max(scores, key=scores.get)]


def test_evaluations_are_written(spark, finished):
    out = finished[1]
    for model in ("rule_based", "tfidf_logreg", "tfidf_linear_svm"):
        report = spark.read.json(f"{out}/sentiment_evaluation/{model}/report")
        assert report.count() == 6
        assert spark.read.json(f"{out}/sentiment_evaluation/{model}/confusion_matrix").agg(F.sum("n")).first()[0] == (
            report.where("label = 'accuracy'").first().support
        )
    terms = spark.read.json(f"{out}/topic_evaluation/top_terms")
    assert {r.method for r in terms.select("method").distinct().collect()} == {"nmf", "lda", "embedding_kmeans"}
    majorities = spark.read.json(f"{out}/topic_evaluation/majorities")
    assert majorities.groupBy("method").agg(F.sum("n").alias("n")).where("n <> 1600").count() == 0


def test_growing_issue_lifts_the_score(finished):
    scored = finished[0]["scored"]
    growing = scored.where("issue_growth_score = 1").select("theme_label_primary").distinct().collect()
    assert [r[0] for r in growing] == ["Payment Issues (Double Charge)"]


def test_pages_and_reports_are_written(spark, finished):
    out = finished[1]
    pages = spark.read.csv(f"{out}/dashboard/page1_executive_overview", header=True).collect()
    assert len(pages) == 1 and pages[0].total_feedback == "1600" and pages[0].emerging_issues_count == "1"
    assert spark.read.csv(f"{out}/dashboard/fact_feedback", header=True).count() == 1600
    assert spark.read.json(f"{out}/explanation_cards").count() == 25
    assert spark.read.csv(f"{out}/reports/sentiment_trend_month", header=True).count() == 9


def test_quality_and_metrics_are_written(spark, finished):
    tables_, out = finished
    checks = {r.check_name: (r.expected, r.actual, r.ok) for r in spark.read.json(f"{out}/quality_checks").collect()}
    assert checks == {
        "rows": (1600, 1600, True), "tiers": (1600, 1600, True),
        "orphans customer_id": (0, 0, True), "orphans product_id": (0, 0, True),
    }
    metrics = spark.read.json(f"{out}/project_metrics").collect()
    assert len(metrics) == 1 and metrics[0].asDict()["orders"] is None
    assert (metrics[0].feedback_interactions, metrics[0].customers, metrics[0].products) == (1600, 60, 6)
    assert sum(metrics[0].priority_distribution.asDict().values()) == 1600
    assert tables_["history"].where("customer_id = 'C7'").count() == tables_["scored"].where("customer_id = 'C7'").count()


def test_csv_round_trip_with_quotes_and_lists(spark, tmp_path):
    kind = "id string, text string, tags array<string>, pairs array<struct<theme:string,sentiment:string>>, d date"
    rows = [("1", 'He said "no", twice', ["a", "b"], [("a", "x")], START), ("2", None, [], [], None)]
    path = str(tmp_path / "t")
    tables.write_csv(spark.createDataFrame(rows, kind), path)
    from pyspark.sql import types as T

    flat = T._parse_datatype_string("id string, text string, tags string, pairs string, d date")
    got = {r.id: r for r in tables.read_csv(spark, path, flat).collect()}
    assert got["1"].text == 'He said "no", twice' and got["1"].tags == "a|b" and got["1"].pairs == "a:x" and got["1"].d == START
    assert got["2"].text is None and got["2"].d is None


FLAT = "id string, n int, x double, text string, d date"


def read_flat(spark, path, text):
    path.write_text(text)
    from pyspark.sql import types as T

    return tables.read_csv(spark, str(path), T._parse_datatype_string(FLAT))


def test_csv_with_line_feeds_and_columns_in_any_order(spark, tmp_path):
    text = 'extra,text,d,x,id,n\nq,"line one\nline two, ""quoted""",2025-03-01,1.5,a,7\n,,,,b,\n'
    got = {r.id: tuple(r) for r in read_flat(spark, tmp_path / "a.csv", text).collect()}
    assert got == {"a": ("a", 7, 1.5, 'line one\nline two, "quoted"', START.replace(2025, 3, 1)), "b": ("b", None, None, None, None)}


def test_csv_without_a_column_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="no column d"):
        read_flat(spark, tmp_path / "b.csv", "id,n,x,text\na,1,1,t\n")


@pytest.mark.parametrize("line", ["a,1,1.0,t,2025-03-01,more", "a,one,1.0,t,2025-03-01", "a,1,1.0,t"])
def test_csv_lines_that_do_not_fit_fail(spark, tmp_path, line):
    with pytest.raises(Exception, match="MALFORMED|CAST_INVALID"):
        read_flat(spark, tmp_path / "c.csv", f"id,n,x,text,d\n{line}\n").collect()


def test_lexicon_file(spark, tmp_path):
    path = tmp_path / "lexicon.json"
    path.write_text('{"b phrase": "t2:negative", "a phrase": "t1:positive"}')
    entries = tables.read_lexicon(spark, str(path))
    assert entries == [c.Phrase("b phrase", "t2", "negative"), c.Phrase("a phrase", "t1", "positive")]
    assert [r.ord for r in tables.lexicon_frame(spark, entries).collect()] == [1, 2]


def test_scratch_folder_is_the_clusters_where_one_is_named(spark, tmp_path):
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")
    named = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: str(tmp_path)))
    assert scratch_dir(named, "x").startswith(f"{tmp_path}/x-")


def test_only_small_inputs_are_spread(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert spread(docs, "doc_id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread(docs, "doc_id", split_bytes=1) is docs


def test_jobs_side_by_side_keep_their_order(spark):
    jobs = [lambda n=n: spark.range(n).count() for n in range(6)]
    assert side_by_side(spark, jobs) == list(range(6))


def test_skewed_dimension_join_is_split(spark):
    """A customer with a third of all rows is cut up when joined to a large dimension."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        fact = spark.range(0, 90_000, 1, 8).select(
            "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("customer_id"),
            F.md5(F.col("id").cast("string")).alias("pad"),
        )
        people = spark.range(90_000).select(F.col("id").alias("customer_id"), F.lit("Gold").alias("tier"))
        joined = fact.join(people, "customer_id", "left")
        assert joined.count() == 90_000
        joined.write.format("noop").mode("overwrite").save()
        rows = joined.collect()
        assert len(rows) == 90_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
