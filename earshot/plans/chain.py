"""The whole job: raw feedback to scored feedback, alerts, cards and dashboard tables.

Each stage takes and returns DataFrames. Two tables are stored on the way,
because many readers follow: the enriched feedback (its models are expensive)
and the scored feedback (nine reports and nine dashboard pages read it).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot import catalogue as c
from earshot.functions.labels import lookup
from earshot.operators import agreement, classifiers, priority, quality, topics, trends, valence
from earshot.operators.features import TermRules, english_stop_words
from earshot.operators.lexicon import tag_messages
from earshot.operators.phrases import phrase_table, tag_messages_by_words
from earshot.plans import marts, reports
from earshot.sources import facts, tables


@dataclass(frozen=True)
class Settings:
    """Vocabulary and thresholds of a run; the defaults suit the shipped catalogue."""

    themes: Sequence[c.Theme] = c.THEMES
    lexicon: Sequence[c.Phrase] = field(default_factory=c.phrase_list)
    keywords: Mapping[str, Sequence[str]] = field(default_factory=lambda: c.ASPECT_KEYWORDS)
    valences: Mapping[str, float] = field(default_factory=lambda: c.STARTER_VALENCES)
    baseline: trends.Baseline = trends.Baseline()
    rule: trends.AlertRule = trends.AlertRule()
    sentiment_terms: TermRules = TermRules()
    topic_min_df: int = 5
    n_topics: int = 10
    embedding_rank: int = 100
    seed: int = 42
    phrase_match: str = "substring"  # or "words", for lexicons of many thousand phrases
    set_bad_lines_aside: bool = False  # feedback lines that do not fit go to out/quarantine

    @property
    def labels(self) -> dict[str, str]:
        return {t.code: t.label for t in self.themes}

    @property
    def aspects(self) -> dict[str, str | None]:
        return {t.code: t.aspect for t in self.themes}


def rule_scorer(spark: SparkSession, valences: Mapping[str, float], doc: str, text: str) -> classifiers.Scorer:
    """Rule-based sentiment with a flat confidence."""
    table = valence.valence_table(spark, valences)

    def score(rows: DataFrame) -> DataFrame:
        return valence.label_rows(rows, doc, text, table).withColumn("sentiment_confidence", F.lit(0.7))

    return score


def predict_sentiment(feedback: DataFrame, settings: Settings) -> tuple[DataFrame, classifiers.Contest]:
    spark = feedback.sparkSession
    contest = classifiers.compare(
        feedback.select("feedback_id", "text", "true_overall_sentiment"),
        "feedback_id", "text", "true_overall_sentiment",
        rule_scorer(spark, settings.valences, "feedback_id", "text"),
        settings.sentiment_terms, seed=settings.seed,
    )
    return contest.score(feedback), contest


def tag_aspects(feedback: DataFrame, settings: Settings) -> DataFrame:
    if settings.phrase_match == "substring":
        return tag_messages(feedback, settings.lexicon, settings.aspects)
    if settings.phrase_match != "words":
        raise ValueError(f"phrase_match must be substring or words, not {settings.phrase_match!r}")
    lexicon = tables.lexicon_frame(feedback.sparkSession, settings.lexicon)
    return tag_messages_by_words(feedback, "feedback_id", phrase_table(lexicon, settings.aspects))


def aspect_comparison(tagged: DataFrame, settings: Settings) -> DataFrame:
    """(approach, correct, total, agreement): clause keywords against the lexicon."""
    spark = tagged.sparkSession
    table = valence.valence_table(spark, settings.valences)
    found = valence.clause_aspects(tagged, "feedback_id", table, keywords=settings.keywords)
    pairs = found.groupBy("feedback_id").agg(
        # at most one pair per aspect
        F.collect_list(F.struct("aspect", F.initcap("label").alias("sentiment"))).alias("naive_aspects")
    )
    empty = F.array().cast("array<struct<aspect:string,sentiment:string>>")
    both = tagged.select("feedback_id", "true_aspect_sentiments", "detected_aspects").join(
        pairs, "feedback_id", "left"
    ).withColumn("naive_aspects", F.coalesce("naive_aspects", empty))
    return agreement.aspect_agreement(both, settings.aspects, detected="naive_aspects").select(
        F.lit("keyword_clauses").alias("approach"), "*"
    ).unionByName(
        agreement.aspect_agreement(both, settings.aspects).select(F.lit("phrase_lexicon").alias("approach"), "*")
    )


def discover_topics(
    feedback: DataFrame, settings: Settings
) -> tuple[DataFrame, topics.TopicContest, topics.Corpus]:
    """Topic columns, the comparison, and the cached corpus to release once they are stored."""
    rules = TermRules(
        min_df=settings.topic_min_df, max_features=5_000, grams=1, stop_words=english_stop_words()
    )
    data = topics.corpus(feedback.select("feedback_id", "text"), "feedback_id", "text", rules)
    truth = feedback.select("feedback_id", F.get("true_themes", 0).alias("truth"))
    contest = topics.compare(data, truth, settings.n_topics, settings.embedding_rank, settings.seed)
    return feedback.join(contest.labelled, "feedback_id", "left"), contest, data


def operational(feedback: DataFrame) -> DataFrame:
    """Feedback without the columns that only evaluation may read."""
    return feedback.drop(*quality.TRUTH_COLUMNS)


def detect_issues(feedback: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """(daily theme shares with labels, alerts)."""
    daily = trends.theme_daily_share(feedback, F.col("feedback_date"))
    metrics = trends.emerging_daily(daily, settings.baseline)
    labelled = daily.withColumn("theme_label", lookup(F.col("theme"), settings.labels))
    return labelled, trends.alerts(metrics, settings.labels, settings.rule)


def dashboard(
    scored: DataFrame, products: DataFrame, daily: DataFrame, alerts: DataFrame
) -> dict[str, DataFrame]:
    return {
        "fact_feedback": marts.fact_feedback(scored),
        "page1_executive_overview": marts.executive(scored, alerts),
        "page2_sentiment_trends": marts.sentiment_trend(scored),
        "page3_topic_intelligence": marts.topic(scored),
        "page4_emerging_issues_daily_trends": daily,
        "page4_emerging_issues_alerts": alerts,
        "page5_product_experience": marts.product(scored, products),
        "page6_support_experience": marts.channel(scored),
        "page7_customer_risk": marts.customer_risk(scored),
        "page8_action_priority_queue": marts.action_queue(scored),
    }


def standing_reports(
    scored: DataFrame, customers: DataFrame, products: DataFrame, daily: DataFrame
) -> dict[str, DataFrame]:
    """The reports that take no parameter; ``customer_360`` takes a customer id."""
    return {
        "sentiment_trend_month": reports.sentiment_trend_month(scored),
        "worsening_products": reports.worsening_products(scored, products),
        "complaint_mix": reports.complaint_mix(scored),
        "repeat_complainers": reports.repeat_complainers(scored, customers),
        "channel_performance": reports.channel_performance(scored),
        "sentiment_churn": reports.sentiment_churn(scored),
        "repeat_gap_days": reports.repeat_gap_days(scored),
        "theme_share_45d": reports.theme_share_recent(daily),
    }


def run(spark: SparkSession, data: str, out: str, settings: Settings | None = None) -> dict[str, DataFrame]:
    """Reads the CSV tables of ``data`` and writes everything below ``out``.

    Feedback, customers and products are needed; orders are only counted, where there are any. The scored
    feedback and the daily themes are stored by month, the messages of a customer together.
    ``quality_checks`` says whether rows, tiers and keys add up, ``project_metrics`` how much there is.
    Returns the stored tables by name.
    """
    settings = settings or Settings()
    aside = f"{out}/quarantine/feedback" if settings.set_bad_lines_aside else None
    feedback = tables.read_feedback(spark, f"{data}/feedback.csv", aside)
    customers = tables.read_csv(spark, f"{data}/customers.csv", tables.CUSTOMERS)
    products = tables.read_csv(spark, f"{data}/products.csv", tables.PRODUCTS)

    def store(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{out}/{name}")
        return spark.read.schema(df.schema).parquet(f"{out}/{name}")

    with_sentiment, sentiment = predict_sentiment(feedback, settings)
    tagged, came_in = quality.written_with(
        tag_aspects(with_sentiment, settings), lambda df: store(df, "feedback_tagged"), "feedback_tagged"
    )
    tables.write_json(aspect_comparison(tagged, settings), f"{out}/aspect_evaluation")
    with_topics, found, cached = discover_topics(tagged, settings)
    enriched = store(with_topics, "feedback_enriched")
    for name, judged in sentiment.judged.items():
        tables.write_json(judged.report, f"{out}/sentiment_evaluation/{name}/report")
        tables.write_json(judged.matrix, f"{out}/sentiment_evaluation/{name}/confusion_matrix")
    tables.write_json(found.terms, f"{out}/topic_evaluation/top_terms")
    tables.write_json(found.majorities, f"{out}/topic_evaluation/majorities")
    cached.release()
    results = [("sentiment", k, float(v), k == sentiment.winner) for k, v in sentiment.macro_f1.items()]
    results += [("topics", k, float(v), k == found.winner) for k, v in found.purity.items()]
    tables.write_json(
        spark.createDataFrame(results, "task string, method string, score double, chosen boolean"),
        f"{out}/model_comparison",
    )

    plain = operational(enriched)
    daily, alerts = detect_issues(plain, settings)
    daily = facts.write_by_month(daily, f"{out}/daily_theme_trends")
    alerts = store(alerts, "emerging_issue_alerts")
    tables.write_json(alerts, f"{out}/emerging_issue_alerts_json")
    scored_plan = priority.score_feedback(plain, customers, settings.themes, alerts)
    quality.assert_no_truth(scored_plan)
    scored, counted = quality.written_with(
        facts.by_month(scored_plan), lambda df: facts.write_by_month(df, f"{out}/feedback_final_scored"),
        "feedback_final_scored", **quality.tier_columns(),
    )
    lost = quality.orphans(scored, {"customer_id": customers, "product_id": products})
    checks = quality.check_table(spark, quality.fact_checks(came_in["rows"], counted, lost))
    tables.write_json(checks, f"{out}/quality_checks")
    has_orders = tables.exists(spark, f"{data}/orders.csv")
    orders = tables.read_csv(spark, f"{data}/orders.csv", tables.ORDERS).count() if has_orders else None
    sizes = {
        "feedback_interactions": counted.pop("rows"), "customers": customers.count(), "products": products.count(),
        "orders": orders,
    }
    tables.write_json(quality.project_metrics(spark, sizes, counted), f"{out}/project_metrics")
    history = facts.write_by_key(
        scored.select(*reports.HISTORY_COLUMNS), f"{out}/customer_history", "customer_id", ("feedback_date", "feedback_id")
    )
    tables.write_json(priority.explanation_cards(scored, settings.themes), f"{out}/explanation_cards")
    for name, mart in dashboard(scored, products, daily, alerts).items():
        tables.write_csv(mart, f"{out}/dashboard/{name}")
    for name, report in standing_reports(scored, customers, products, daily).items():
        tables.write_csv(report, f"{out}/reports/{name}")
    return {"enriched": enriched, "daily": daily, "alerts": alerts, "scored": scored, "history": history}
