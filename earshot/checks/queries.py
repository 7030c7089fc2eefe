"""One callable per operator over the driver's tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.catalogue import UNCLASSIFIED
from earshot.checks import tables as t
from earshot.functions import numbers, text as tx
from earshot.functions.labels import label_or_code, lookup, majority_label
from earshot.operators import (
    agreement, classifiers, features, history, kmeans, lexicon, priority, quality, ranking, topics, trends, valence,
)
from earshot.operators import phrases as phrases_of
from earshot.plans import marts, reports
from earshot.session import scratch_dir
from earshot.sources import facts
from earshot.streaming import counts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Thresholds low enough to flag something in the smooth test series.
RELAXED = trends.AlertRule(z=1.0, change=0.25, critical_z=1.5)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def scored(spark: SparkSession, sf_dir: str, with_alerts: bool = False) -> DataFrame:
    active = None
    if with_alerts:
        active = trends.alerts(metrics(spark, sf_dir), t.LABELS, RELAXED)
    return priority.score_feedback(
        t.feedback(spark, sf_dir), t.customers(spark, sf_dir), t.THEMES, active
    )


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.theme_daily_share(t.feedback(spark, sf_dir), F.col("feedback_date"))


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.emerging_daily(daily(spark, sf_dir))


def six(*names: str):
    return [numbers.half_away(F.col(n), 6).alias(n) for n in names]


def flags():
    default, relaxed = trends.AlertRule(), RELAXED
    z, change = numbers.half_away(F.col("z_score"), 6), numbers.half_away(F.col("change"), 6)

    def flag(rule):
        return F.coalesce((z > rule.z) & (change > rule.change), F.lit(False)).cast("int")

    return [flag(default).alias("is_alert"), flag(relaxed).alias("is_relaxed_alert")]


# --- reports ----------------------------------------------------------------


@query
def sentiment_trend_month(spark, sf_dir):
    return reports.sentiment_trend_month(t.plain_feedback(spark, sf_dir))


@query
def worsening_products(spark, sf_dir):
    return reports.worsening_products(
        t.feedback(spark, sf_dir), t.products(spark, sf_dir), by="category", least=10
    )


@query
def complaint_mix(spark, sf_dir):
    return reports.complaint_mix(t.labelled_feedback(spark, sf_dir))


@query
def repeat_complainers(spark, sf_dir):
    return reports.repeat_complainers(t.plain_feedback(spark, sf_dir), t.customers(spark, sf_dir))


@query
def customer_360(spark, sf_dir):
    return reports.customer_360(scored(spark, sf_dir), 7)


@query
def channel_performance(spark, sf_dir):
    return reports.channel_performance(scored(spark, sf_dir))


@query
def sentiment_churn(spark, sf_dir):
    return reports.sentiment_churn(scored(spark, sf_dir))


@query
def repeat_gap_days(spark, sf_dir):
    return reports.repeat_gap_days(t.labelled_feedback(spark, sf_dir))


@query
def theme_share_45d(spark, sf_dir):
    labelled = daily(spark, sf_dir).withColumn("theme_label", lookup(F.col("theme"), t.LABELS))
    return reports.theme_share_recent(labelled)


# --- projections, lookups, strings ------------------------------------------


@query
def theme_labels(spark, sf_dir):
    rows = t.labelled_feedback(spark, sf_dir)
    severity = {th.code: th.severity for th in t.THEMES}
    return rows.select(
        "feedback_id", "primary_theme", "theme_label_primary",
        label_or_code(F.col("primary_theme"), t.LABELS).alias("label_or_code"),
        F.coalesce(lookup(F.col("primary_theme"), severity), F.lit(0.4)).alias("theme_severity"),
    )


@query
def theme_strings(spark, sf_dir):
    """Lists to pipe-joined text and back."""
    rows = t.feedback(spark, sf_dir).select("feedback_id", "predicted_sentiment", "inferred_themes")
    pairs = F.transform("inferred_themes", lambda th: F.struct(th.alias("theme"), F.col("predicted_sentiment").alias("sentiment")))
    written = rows.select(
        "feedback_id",
        tx.joined(F.col("inferred_themes")).alias("theme_text"),
        tx.joined_pairs(pairs).alias("pair_text"),
    )
    themes, parsed = tx.split_list(F.col("theme_text")), tx.split_pairs(F.col("pair_text"))
    return written.select(
        "feedback_id", "theme_text", "pair_text",
        F.get(themes, 0).alias("first_theme"), F.size(themes).alias("n_themes"),
        F.try_element_at(parsed, F.lit(-1))["theme"].alias("last_theme"),
        F.try_element_at(parsed, F.lit(-1))["sentiment"].alias("last_sentiment"),
    )


@query
def order_value(spark, sf_dir):
    lines = t.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    prices = t.products(spark, sf_dir).select(F.col("product_id").alias("l_partkey"), "price")
    return lines.join(prices, "l_partkey", "left").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        numbers.half_even(F.col("price") * F.col("l_quantity"), 2).alias("order_value"),
    )


@query
def majority_sentiment(spark, sf_dir):
    counted = agreement.majority_rows(t.aspect_labels(spark, sf_dir), "feedback_id", "label")
    vote = majority_label(F.col("negatives"), F.col("neutrals"), F.col("positives"))
    return counted.select("*", vote.alias("overall_sentiment"))


@query
def margin_confidence(spark, sf_dir):
    rows = t.plain_feedback(spark, sf_dir)
    return classifiers.margin_confidence(rows, "o_totalprice").select("feedback_id", "sentiment_confidence")


@query
def stratified_split(spark, sf_dir):
    rows = t.plain_feedback(spark, sf_dir).select("feedback_id", "predicted_sentiment")
    key = (F.col("feedback_id") * 48271 + 42) % 2147483647
    marked = ranking.stratified_split(
        rows, "predicted_sentiment", "feedback_id", key=key, key_bits=31
    )
    return marked.withColumn("is_test", F.col("is_test").cast("int"))


# --- history, ranks, priority ------------------------------------------------


@query
def prior_complaints(spark, sf_dir):
    rows = t.plain_feedback(spark, sf_dir)
    return history.prior_complaints(rows).select("feedback_id", "customer_id", "repeat_negative_count")


@query
def prior_complaints_split(spark, sf_dir):
    """The same counts with every customer-day of more than one message cut into ranges."""
    rows = t.plain_feedback(spark, sf_dir)
    split = history.prior_complaints(rows, hot_day=1)
    return split.select("feedback_id", "customer_id", "repeat_negative_count")


@query
def value_percentile(spark, sf_dir):
    rows, people = t.plain_feedback(spark, sf_dir), t.customers(spark, sf_dir)
    profile = priority.customer_profile(rows, people).select("customer_id", "customer_value_score")
    return rows.join(profile, "customer_id", "left").select(
        "feedback_id", numbers.half_away(F.col("customer_value_score"), 9).alias("customer_value_score")
    )


@query
def priority_components(spark, sf_dir):
    return scored(spark, sf_dir, with_alerts=True).select("feedback_id", *six(*priority.COMPONENTS))


@query
def priority_score(spark, sf_dir):
    return scored(spark, sf_dir, with_alerts=True).select(
        "feedback_id", "repeat_negative_count", "priority_score", "priority_tier"
    )


@query
def priority_tiers(spark, sf_dir):
    return priority.distribution(scored(spark, sf_dir), "priority_tier")


@query
def priority_sanity(spark, sf_dir):
    return priority.urgent_sentiment_mix(scored(spark, sf_dir))


@query
def top_priority(spark, sf_dir):
    return priority.top_priority(scored(spark, sf_dir)).select(
        "feedback_id", "customer_id", "priority_score", "priority_tier"
    )


@query
def explain_cards(spark, sf_dir):
    cards = priority.explanation_cards(scored(spark, sf_dir, with_alerts=True), t.THEMES)
    return cards.withColumn("secondary_issues", tx.joined(F.col("secondary_issues"))).withColumn(
        "part_of_emerging_issue", F.col("part_of_emerging_issue").cast("int")
    )


# --- trends -------------------------------------------------------------------


@query
def theme_daily_share(spark, sf_dir):
    return daily(spark, sf_dir).withColumn("theme_label", lookup(F.col("theme"), t.LABELS))


@query
def theme_calendar(spark, sf_dir):
    return trends.densify(
        daily(spark, sf_dir), "theme", "feedback_date", "interval 1 day",
        {"theme_share": 0.0, "theme_count": 0},
    )


@query
def emerging_daily(spark, sf_dir):
    return metrics(spark, sf_dir).select(
        "theme", "feedback_date", "theme_count",
        *six("theme_share", "baseline_mean", "baseline_std", "recent_avg", "z_score", "change"),
        *flags(),
    )


@query
def emerging_hourly(spark, sf_dir):
    """The same metrics over the hourly share of each event type."""
    events = t.read(spark, sf_dir, "events").select(
        F.date_trunc("hour", "ts").alias("hour"), F.array("event_type").alias("inferred_themes")
    )
    shares = trends.theme_daily_share(events, F.col("hour")).withColumnRenamed("feedback_date", "hour")
    dense = trends.densify(
        shares, "theme", "hour", "interval 1 hour", {"theme_share": 0.0, "theme_count": 0}
    )
    out = trends.rolling_metrics(dense, "theme", "hour", "theme_share")
    return out.select(
        "theme", F.date_format("hour", "yyyy-MM-dd HH").alias("hour"), "theme_count",
        *six("theme_share", "baseline_mean", "baseline_std", "recent_avg", "z_score", "change"),
        *flags(),
    )


@query
def emerging_latest(spark, sf_dir):
    return trends.latest_per_theme(metrics(spark, sf_dir)).select(
        "theme", "feedback_date",
        *six("theme_share", "baseline_mean", "baseline_std", "recent_avg", "z_score", "change"),
        *flags(),
    )


@query
def alert_messages(spark, sf_dir):
    return trends.alerts(metrics(spark, sf_dir), t.LABELS, trends.AlertRule(z=-1.0, change=-0.5, critical_z=0.5))


@query
def theme_rate_split(spark, sf_dir):
    rows = t.feedback(spark, sf_dir)
    cutoff = F.date_sub(t.plain_feedback(spark, sf_dir).agg(F.max("feedback_date")).scalar(), 90)
    return trends.rate_split(rows, "PROMO", F.col("feedback_date"), cutoff)


# --- marts ----------------------------------------------------------------------


@query
def mart_fact_feedback(spark, sf_dir):
    return marts.fact_feedback(scored(spark, sf_dir))


@query
def mart_executive(spark, sf_dir):
    found = trends.latest_per_theme(metrics(spark, sf_dir)).where(trends.flagged(RELAXED))
    return marts.executive(
        scored(spark, sf_dir), found, churn_cut=0.2, dates=t.plain_feedback(spark, sf_dir)
    )


@query
def mart_sentiment_trend(spark, sf_dir):
    return marts.sentiment_trend(t.plain_feedback(spark, sf_dir))


@query
def mart_topic(spark, sf_dir):
    return marts.topic(scored(spark, sf_dir))


@query
def mart_product(spark, sf_dir):
    return marts.product(scored(spark, sf_dir), t.products(spark, sf_dir))


@query
def mart_channel(spark, sf_dir):
    return marts.channel(scored(spark, sf_dir))


@query
def mart_customer_risk(spark, sf_dir):
    page = marts.customer_risk(scored(spark, sf_dir))
    # compared to nine decimals: the SQL adds doubles in any order
    return page.withColumn("avg_churn_risk_score", numbers.half_away(F.col("avg_churn_risk_score"), 9))


@query
def action_queue(spark, sf_dir):
    return marts.action_queue(scored(spark, sf_dir))


@query
def mart_roundtrip(spark, sf_dir):
    """The fact mart beside free text with line feeds, written to CSV and read back by its declared schema."""
    from earshot.sources.tables import read_csv, write_csv

    mart = marts.fact_feedback(scored(spark, sf_dir))
    texts = t.read(spark, sf_dir, "documents").select(F.col("doc_id").alias("feedback_id"), "text")
    mart = mart.join(texts, "feedback_id", "left")
    path = scratch_dir(spark, "mart_fact_feedback")
    write_csv(mart, path)
    return read_csv(spark, path, mart.schema)


# --- stored tables ---------------------------------------------------------------


def stored_fact(spark, sf_dir, **counts):
    """The scored feedback by month, and what was counted while it was written."""
    path = scratch_dir(spark, "stored-fact")
    rows = facts.by_month(scored(spark, sf_dir))
    return quality.written_with(rows, lambda df: facts.write_by_month(df, path), "stored_fact", **counts)


@query
def worsening_products_stored(spark, sf_dir):
    """The report over the fact stored by month: only the months of its two periods are read."""
    fact, _ = stored_fact(spark, sf_dir)
    return reports.worsening_products(fact, t.products(spark, sf_dir), by="category", least=10)


@query
def theme_share_45d_stored(spark, sf_dir):
    labelled = daily(spark, sf_dir).withColumn("theme_label", lookup(F.col("theme"), t.LABELS))
    return reports.theme_share_recent(facts.write_by_month(labelled, scratch_dir(spark, "stored-daily")))


@query
def mart_executive_stored(spark, sf_dir):
    fact, _ = stored_fact(spark, sf_dir)
    found = trends.latest_per_theme(metrics(spark, sf_dir)).where(trends.flagged(RELAXED))
    return marts.executive(fact, found, churn_cut=0.2)


@query
def customer_360_stored(spark, sf_dir):
    """One customer's messages from files that hold the messages of a customer together."""
    history = scored(spark, sf_dir).select(*reports.HISTORY_COLUMNS)
    path = scratch_dir(spark, "customer-history")
    return reports.customer_360(facts.write_by_key(history, path, "customer_id", ("feedback_date", "feedback_id")), 7)


# --- quality ---------------------------------------------------------------------


@query
def dq_row_counts(spark, sf_dir):
    def raw(name):
        return t.read(spark, sf_dir, name)

    return quality.row_counts(
        {
            "feedback": (raw("orders"), t.feedback(spark, sf_dir)),
            "customers": (raw("customer"), t.customers(spark, sf_dir)),
            "products": (raw("part"), t.products(spark, sf_dir)),
            "feedback with a theme": (raw("orders"), t.order_themes(spark, sf_dir)),
        }
    ).withColumn("ok", F.col("ok").cast("int"))


@query
def dq_checks(spark, sf_dir):
    """The checks of a fact as it is written, and the same three where something is amiss."""
    source = t.read(spark, sf_dir, "orders").count()
    fact, counts = stored_fact(spark, sf_dir, **quality.tier_columns())
    people, goods = t.customers(spark, sf_dir), t.products(spark, sf_dir)
    checks = quality.fact_checks(source, counts, quality.orphans(fact, {"customer_id": people, "product_id": goods}))
    lacking, partial = stored_fact(spark, sf_dir, **quality.tier_columns(("Critical", "High")))
    lost = quality.orphans(lacking, {"customer_id": people.where("tier <> 'Gold'"), "product_id": goods.where("quality_risk = 'normal'")})
    amiss = quality.fact_checks(source + 1, partial, lost)
    named = [(c.name, c) for c in checks] + [(f"amiss: {c.name}", c) for c in amiss]
    return quality.check_table(spark, [quality.Check(n, c.expected, c.actual) for n, c in named]).withColumn("ok", F.col("ok").cast("int"))


@query
def project_metrics(spark, sf_dir):
    """The summary file, with the tier counts of the pass that wrote the fact, written and read back."""
    from earshot.sources.tables import write_json

    _, counts = stored_fact(spark, sf_dir, **quality.tier_columns())
    sizes = {"feedback_interactions": counts.pop("rows")} | {
        name: t.read(spark, sf_dir, table).count()
        for name, table in (("customers", "customer"), ("products", "part"), ("orders", "lineitem"))
    }
    made, path = quality.project_metrics(spark, sizes, counts), scratch_dir(spark, "project-metrics")
    write_json(made, path)
    read = spark.read.schema(made.schema).json(path)
    plain = F.map_concat(
        F.create_map(*[part for name in sizes for part in (F.lit(name), F.col(name))]),
        F.transform_keys("priority_distribution", lambda k, _: F.concat(F.lit("priority_distribution."), k)),
    )
    return read.select(F.explode(plain).alias("metric", "n"))


@query
def dq_tier_reconcile(spark, sf_dir):
    """Over the whole fact, and over a table in which the tier of a channel is missing."""
    whole = scored(spark, sf_dir)
    broken = whole.withColumn("priority_tier", F.when(F.col("channel") != "1-URGENT", F.col("priority_tier")))
    both = [priority.tier_counts(rows).select(F.lit(name).alias("fact"), "*") for name, rows in (("whole", whole), ("broken", broken))]
    return both[0].unionByName(both[1]).withColumn("adds_up", F.col("adds_up").cast("int"))


@query
def dq_orphans(spark, sf_dir):
    fact = t.feedback(spark, sf_dir)
    return quality.orphans(
        fact, {"customer_id": t.customers(spark, sf_dir), "product_id": t.products(spark, sf_dir)}
    )


# --- text --------------------------------------------------------------------------


@query
def lexicon_table(spark, sf_dir):
    """Nested phrase lists, one per part, flattened to one row per phrase."""
    nested = t.read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("position"),
        F.col("p_type").alias("theme"),
        F.create_map(
            F.lit("negative"), F.array(F.upper("p_name"), F.concat_ws(" ", "p_brand", "p_name")),
            F.lit("positive"), F.array(F.concat_ws(" ", "p_name", F.col("p_size").cast("string"))),
        ).alias("phrases"),
    )
    return lexicon.flatten_lexicon(nested)


@query
def lexicon_hits(spark, sf_dir):
    docs = t.documents(spark, sf_dir)
    hits = lexicon.lexicon_hits(F.col("text"), t.DOC_LEXICON, t.DOC_ASPECTS)
    return docs.select("doc_id", F.inline(hits))


#: Words and numbers of one or more characters, for messages that name products.
PART_WORDS = "[a-z0-9]+"
PART_ASPECTS = {th.code: th.aspect for th in t.THEMES}


def part_phrases(spark, sf_dir):
    """Four phrases for each part, some thousand of them different; shared ones keep their first place."""
    kinds = (
        ("negative", ("p_name", "p_size")), ("positive", ("p_type", "p_name", "p_size")),
        ("neutral", ("p_brand", "p_type", "p_name")), ("negative", ("p_brand", "p_type", "p_name", "p_size")),
    )
    listed = F.array(*[
        F.struct(F.lit(i).alias("kind"), F.lit(sentiment).alias("sentiment"),
                 F.concat_ws(" ", *[F.col(c).cast("string") for c in columns]).alias("phrase"))
        for i, (sentiment, columns) in enumerate(kinds)
    ])
    parts = t.read(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("theme"), F.inline(listed))
    return parts.select((F.col("p_partkey") * len(kinds) + F.col("kind")).alias("ord"), "phrase", "theme", "sentiment")


def order_texts(spark, sf_dir):
    """(doc_id, text): an order's parts in words, every other line without its brand."""
    lines = t.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    parts = t.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type", "p_name", "p_size")
    size = F.col("p_size").cast("string")
    short = F.concat_ws(" ", "p_type", "p_name", F.lit("-"), size)
    text = F.when(F.col("l_linenumber") % 2 == 0, short).otherwise(F.concat_ws(" ", "p_brand", "p_type", "p_name", size))
    listed = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", F.col("text"))))
    said = lines.join(parts, "l_partkey").select("l_orderkey", "l_linenumber", "l_partkey", text.alias("text"))
    # dealt as rows: the join scatters an order's lines, and lists of one line each would be sorted, spilled and shuffled
    said = said.repartition("l_orderkey").groupBy(F.col("l_orderkey").alias("doc_id")).agg(listed.alias("lines"))
    return said.select("doc_id", F.array_join(F.transform("lines", lambda x: x["text"]), "; ").alias("text"))


@query
def lexicon_hits_words(spark, sf_dir):
    """Some thousand phrases made from the parts, looked up as word n-grams of the orders."""
    phrases = phrases_of.phrase_table(part_phrases(spark, sf_dir), PART_ASPECTS, PART_WORDS)
    return phrases_of.word_hits(order_texts(spark, sf_dir), ["doc_id"], "text", phrases, PART_WORDS)


@query
def lexicon_words_tags(spark, sf_dir):
    """Aspects and themes from the same phrases, one row for each order that has lines."""
    phrases = phrases_of.phrase_table(part_phrases(spark, sf_dir), PART_ASPECTS, PART_WORDS)
    tagged = phrases_of.tag_messages_by_words(order_texts(spark, sf_dir), "doc_id", phrases, pattern=PART_WORDS)
    return tagged.select(
        "doc_id", tx.joined_pairs(F.col("detected_aspects"), "aspect", empty="None Detected").alias("detected_aspects"),
        "n_aspects_detected", tx.joined(F.col("inferred_themes")).alias("inferred_themes"),
    )


@query
def infer_themes(spark, sf_dir):
    docs = t.documents(spark, sf_dir)
    hits = lexicon.lexicon_hits(F.col("text"), t.DOC_LEXICON, t.DOC_ASPECTS)
    return docs.select("doc_id", tx.joined(lexicon.themes_of(hits)).alias("inferred_themes"))


@query
def lexicon_aspects(spark, sf_dir):
    docs = lexicon.tag_messages(t.documents(spark, sf_dir), t.DOC_LEXICON, t.DOC_ASPECTS)
    return docs.select(
        "doc_id",
        tx.joined_pairs(F.col("detected_aspects"), "aspect", empty="None Detected").alias("detected_aspects"),
        "n_aspects_detected",
        tx.joined(F.col("inferred_themes")).alias("inferred_themes"),
    )


def _doc_valence(spark, sf_dir):
    table = valence.valence_table(spark, t.DOC_VALENCES)
    return valence.valence_scores(
        t.documents(spark, sf_dir), ["doc_id"], F.col("text"), table, tx.ASCII_WORDS
    )


@query
def valence_sentiment(spark, sf_dir):
    return _doc_valence(spark, sf_dir).select(
        "doc_id", F.col("total").cast("long").alias("total"), *six("compound"), "label"
    )


@query
def keyword_aspects(spark, sf_dir):
    """Keyword aspects, each labelled with the sentiment of its whole document."""
    docs = t.documents(spark, sf_dir)
    found = docs.select("doc_id", F.inline(lexicon.keyword_aspects(F.col("text"), t.DOC_KEYWORDS)))
    return found.join(_doc_valence(spark, sf_dir).select("doc_id", "label"), "doc_id")


@query
def keyword_aspect_clauses(spark, sf_dir):
    table = valence.valence_table(spark, t.DOC_VALENCES)
    docs = t.documents(spark, sf_dir)
    found = valence.clause_aspects(docs, "doc_id", table, keywords=t.DOC_KEYWORDS, pattern=tx.ASCII_WORDS)
    return found.select("doc_id", "ord", "aspect", *six("compound"), "label")


@query
def clause_split(spark, sf_dir):
    docs = t.documents(spark, sf_dir)
    return docs.select("doc_id", F.posexplode(tx.clauses(F.col("text"))).alias("pos", "clause"))


@query
def aspect_agreement(spark, sf_dir):
    docs = lexicon.tag_messages(t.labelled_documents(spark, sf_dir), t.DOC_LEXICON, t.DOC_ASPECTS)
    return agreement.aspect_agreement(docs, t.DOC_ASPECTS)


def _judged(spark, sf_dir):
    truth = t.labelled_documents(spark, sf_dir).select("doc_id", "truth")
    guess = _doc_valence(spark, sf_dir).select("doc_id", F.col("label").alias("predicted"))
    return truth.join(guess, "doc_id")


@query
def confusion_matrix(spark, sf_dir):
    return agreement.confusion_matrix(_judged(spark, sf_dir), "truth", "predicted")


@query
def classification_report(spark, sf_dir):
    matrix = agreement.confusion_matrix(_judged(spark, sf_dir), "truth", "predicted")
    return agreement.classification_report(matrix).select(
        "label", *six("precision", "recall", "f1"), "support"
    )


# --- features and models ------------------------------------------------------------

#: Words left out of the topic features of the test documents.
STOP_WORDS = ("the", "and", "of", "to", "in", "is", "that", "it", "was", "for", "on", "with", "this", "as", "be", "are", "by")
TOPIC_RULES = features.TermRules(min_df=5, max_features=5000, grams=1, stop_words=STOP_WORDS, pattern=tx.ASCII_WORDS)
SENTIMENT_RULES = features.TermRules(min_df=3, max_features=20000, grams=2)
N_TOPICS = 4


@query
def term_counts(spark, sf_dir):
    return features.vocabulary_counts(t.documents(spark, sf_dir), "doc_id", "text", TOPIC_RULES)


@query
def tfidf_weights(spark, sf_dir):
    out = features.tfidf_weights(t.documents(spark, sf_dir), "doc_id", "text", TOPIC_RULES)
    return out.select("doc_id", "term", "idx", "tf", *six("weight"))


@query
def tfidf_features(spark, sf_dir):
    """Profile of the document vectors over words and word pairs."""
    docs = t.documents(spark, sf_dir)
    rules = replace(SENTIMENT_RULES, pattern=tx.ASCII_WORDS)
    fitted = features.fit_features(docs, "text", rules)
    profile = features.feature_profile(fitted.tfidf(docs, "text"), fitted)
    return profile.select("term", "n_docs", *six("weight_sum"))


def _split(spark, sf_dir):
    return ranking.stratified_split(t.labelled_documents(spark, sf_dir), "truth", "doc_id")


def _trained(spark, sf_dir):
    return classifiers.training_set(
        _split(spark, sf_dir).where(~F.col("is_test")), "doc_id", "text", "truth", SENTIMENT_RULES
    )


def _rule_scorer(spark):
    table = valence.valence_table(spark, t.DOC_VALENCES)

    def score(rows):
        labelled = valence.label_rows(rows, "doc_id", "text", table, tx.ASCII_WORDS)
        return labelled.withColumn("sentiment_confidence", F.lit(0.7))

    return score


def _predictions(rows):
    return rows.select("doc_id", "predicted_sentiment", "sentiment_confidence")


@query
def sentiment_logreg(spark, sf_dir):
    data = _trained(spark, sf_dir)
    return _predictions(classifiers.fit_logistic(data)(t.documents(spark, sf_dir)))


@query
def sentiment_svm(spark, sf_dir):
    data = _trained(spark, sf_dir)
    return _predictions(classifiers.fit_svm(data)(t.documents(spark, sf_dir)))


@query
def sentiment_champion(spark, sf_dir):
    contest = classifiers.compare(
        t.labelled_documents(spark, sf_dir), "doc_id", "text", "truth", _rule_scorer(spark), SENTIMENT_RULES
    )
    return _predictions(contest.score(t.documents(spark, sf_dir))).withColumn("model", F.lit(contest.winner))


def _corpus(spark, sf_dir):
    return topics.corpus(t.documents(spark, sf_dir), "doc_id", "text", TOPIC_RULES)


@query
def topics_nmf(spark, sf_dir):
    return topics.by_nmf(_corpus(spark, sf_dir), N_TOPICS).assigned


@query
def topics_lda(spark, sf_dir):
    return topics.by_lda(_corpus(spark, sf_dir), N_TOPICS).assigned


@query
def lsa_embedding(spark, sf_dir):
    return topics.lsa_embedding(_corpus(spark, sf_dir))


@query
def topic_top_terms(spark, sf_dir):
    data = _corpus(spark, sf_dir)
    return topics.top_terms(data, topics.by_nmf(data, N_TOPICS))


@query
def topics_champion(spark, sf_dir):
    truth = t.documents(spark, sf_dir).select("doc_id", F.col("lang").alias("truth"))
    contest = topics.compare(_corpus(spark, sf_dir), truth, N_TOPICS)
    return contest.labelled.withColumn("method", F.lit(contest.winner))


def _argmax_rows(spark, sf_dir):
    return t.read(spark, sf_dir, "embeddings").select(
        "vec_id", "label", classifiers.argmax(F.col("embedding")).alias("topic")
    )


@query
def topic_argmax(spark, sf_dir):
    return _argmax_rows(spark, sf_dir)


@query
def topic_purity(spark, sf_dir):
    return agreement.purity(_argmax_rows(spark, sf_dir), "topic", "label")


@query
def topic_majority(spark, sf_dir):
    return agreement.cluster_majority(_argmax_rows(spark, sf_dir), "topic", "label")


@query
def topics_kmeans(spark, sf_dir):
    rows = t.read(spark, sf_dir, "embeddings")
    return topics.by_kmeans(rows, "vec_id", k=10).assigned


@query
def kmeans_given_start(spark, sf_dir):
    """Two rounds from the ten smallest ids, then the nearest centre of every vector."""
    rows = t.read(spark, sf_dir, "embeddings")
    first = rows.orderBy("vec_id").limit(10).select("embedding").collect()
    start = np.array([r[0] for r in first], float)
    found = kmeans.fit(rows, "embedding", len(first), (0,), max_iter=3, tol=0.0, start=start)
    return found.assign(rows, "vec_id", "embedding")


@query
def cluster_top_terms(spark, sf_dir):
    """Top terms of given clusters, the languages of the documents."""
    data = _corpus(spark, sf_dir)
    number = {"de": 0, "en": 1, "es": 2, "fr": 3}
    given = t.documents(spark, sf_dir).select("doc_id", lookup(F.col("lang"), number).alias("topic"))
    found = topics.top_terms(data, topics.Topics(given, None), n=5)
    return found.select("topic", "rank", "term", *six("weight"))


@query
def dominant_truth(spark, sf_dir):
    rows = t.labelled_documents(spark, sf_dir)
    return rows.select("doc_id", F.get("true_aspect_sentiments", 0)["theme"].alias("dominant_true_theme"))


@query
def explain_cards_stored(spark, sf_dir):
    """The cards as a JSON report, written and read back."""
    from earshot.sources.tables import write_json

    cards, path = explain_cards(spark, sf_dir), scratch_dir(spark, "cards")
    write_json(cards, path)
    return spark.read.schema(cards.schema).json(path)


@query
def lexicon_file(spark, sf_dir):
    """A lexicon file with a phrase for each brand and type, read back in the order of the file."""
    from earshot.sources.tables import lexicon_frame, read_lexicon

    phrase = F.lower(F.concat_ws(" ", "p_brand", "p_type"))
    meaning = F.concat_ws(":", "p_type", F.when(F.col("p_type") == "PROMO", "positive").otherwise("negative"))
    pairs = t.read(spark, sf_dir, "part").select(F.struct(phrase.alias("k"), meaning.alias("v")).alias("e")).distinct()
    path = scratch_dir(spark, "lexicon-file")  # one small object, as written by hand
    pairs.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list("e")))).alias("value")).write.text(path)
    return lexicon_frame(spark, read_lexicon(spark, path))


# --- streaming ------------------------------------------------------------------------


@query
def stream_theme_counts(spark, sf_dir):
    source = counts.parquet_stream(spark, sf_dir, "events.parquet", t.SCHEMAS["events"])
    return counts.daily_theme_counts(source, "ts", "event_type")


@query
def stream_emerging(spark, sf_dir):
    """Spike metrics from a stream of messages: orders arrive as a stream, their themes lie in a table."""
    base = scratch_dir(spark, "stream-emerging")
    orders = counts.parquet_stream(spark, sf_dir, "orders.parquet", t.SCHEMAS["orders"])
    themed = t.order_themes(spark, sf_dir).select(F.col("feedback_id").alias("o_orderkey"), "found")
    found = F.coalesce("found", F.array(F.lit(UNCLASSIFIED)))
    messages = orders.select("o_orderkey", "o_orderdate").join(themed, "o_orderkey", "left").withColumn("inferred_themes", found)
    table = counts.CountTable(spark, f"{base}/counts")
    counts.follow(messages, table, f"{base}/checkpoint", "o_orderdate").awaitTermination()
    return trends.emerging_daily(table.shares()).select(
        "theme", "feedback_date", "theme_count",
        *six("theme_share", "baseline_mean", "baseline_std", "recent_avg", "z_score", "change"),
        *flags(),
    )


# --- sources --------------------------------------------------------------------------


def feedback_lines(spark, sf_dir):
    """CSV lines of the orders, some of them spoilt, in eight files that begin with a header."""
    key, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    fields = [
        key.cast("string"), F.when(key % 11 == 3, "none").otherwise(F.col("o_custkey").cast("string")),
        F.when(key % 13 == 5, F.concat(F.lit("on "), day)).otherwise(day),
        F.when(key % 17 == 7, "").otherwise(F.col("o_totalprice").cast("decimal(20,2)").cast("string")),
        F.concat(F.lit('"a, ""quoted"" note '), key.cast("string"), F.lit('"')),
    ]
    whole = F.concat_ws(",", *fields)
    line = F.when(key % 19 == 2, F.concat_ws(",", *fields[:3])).when(key % 23 == 4, F.concat(whole, F.lit(",extra"))).otherwise(whole)
    rows = t.read(spark, sf_dir, "orders").select((key % 8).alias("file"), F.lit(1).alias("place"), line.alias("line"))
    head = spark.range(8).select(
        F.col("id").alias("file"), F.lit(0).alias("place"), F.lit("order_id,customer_id,order_date,order_value,note").alias("line")
    )
    path = scratch_dir(spark, "spoilt-lines")
    sorted_lines = rows.unionByName(head).repartition("file").sortWithinPartitions("file", "place")
    sorted_lines.select("file", "line").write.partitionBy("file").text(path)
    return f"{path}/*"


@query
def csv_quarantine(spark, sf_dir):
    """Lines read, kept and set aside, by reason; the kept values and the stored records are summed up."""
    from earshot.sources.tables import quarantine

    schema = T.StructType.fromDDL("customer_id long, order_date date, order_value double, order_id long")
    aside = scratch_dir(spark, "quarantine")
    good = quarantine(spark, feedback_lines(spark, sf_dir), schema, aside, multi_line=False)
    kept = good.agg(
        F.lit("kept").alias("reason"), F.count(F.lit(1)).alias("n"), F.sum("order_id").alias("ids"),
        F.count("order_value").alias("n_values"),
    )
    bad = spark.read.schema("file string, reason string, record string").json(aside)
    first = F.split("record", ",")[0].cast("long")
    return kept.unionByName(
        bad.groupBy("reason").agg(F.count("file").alias("n"), F.sum(first).alias("ids"), F.lit(0).cast("long").alias("n_values"))
    )
