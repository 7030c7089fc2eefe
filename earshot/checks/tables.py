"""The driver's test tables seen as feedback tables.

Sentiment, confidence, tier and churn are stand-ins taken from columns of the
star schema: they exercise the operators and mean nothing. The text tables are
real text. The star schema has no feedback, so orders act as messages, the part
types of an order as its themes, customers and parts as the dimensions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.catalogue import UNCLASSIFIED, Phrase, Theme, phrase_list
from earshot.functions.labels import lookup

#: Stand-in themes in lexicon order; two of them share an aspect and one has none.
THEMES = (
    Theme("STANDARD", "Standard", 0.45, "Basics"),
    Theme("ECONOMY", "Economy", 0.65, "Basics"),
    Theme("MEDIUM", "Medium", 0.55, "Size"),
    Theme("SMALL", "Small", 0.35, "Size"),
    Theme("LARGE", "Large", 0.75, "Size"),
    Theme("PROMO", "Promotion", 0.95, None),
)
LABELS = {t.code: t.label for t in THEMES}
SENTIMENT_OF = {"F": "negative", "O": "neutral", "P": "positive"}
SENTIMENT_OF_FLAG = {"R": "negative", "N": "neutral", "A": "positive"}
TIER_OF = {
    "BUILDING": "Bronze", "AUTOMOBILE": "Bronze", "FURNITURE": "Silver",
    "HOUSEHOLD": "Gold", "MACHINERY": "Platinum",
}
CHURN_OF = {"Bronze": 0.28, "Silver": 0.18, "Gold": 0.10, "Platinum": 0.05}

#: Stand-in vocabulary for the documents table.
DOC_ASPECTS = {
    "insult": "Tone", "contempt": "Tone", "licence": "Terms", "rights": "Terms",
    "praise": "Praise", "filler": None,
}
DOC_PHRASES = {
    "insult": {"negative": ["trash", "worthless", "idiot", "moron", "loser", "clown"]},
    "contempt": {"negative": ["stupid", "pathetic", "disgusting", "vile"], "neutral": ["only this"]},
    "licence": {
        "neutral": [
            "licensed under the apache license", "released under the mit license",
            "gnu general public license",
        ]
    },
    "rights": {"neutral": ["all rights reserved"], "positive": ["Released under"]},
    "praise": {"positive": ["best", "on time", "thand", "nicht", "para ", "elle"]},
    "filler": {"neutral": ["the and", "of the"], "negative": ["er on"]},
}
DOC_LEXICON: list[Phrase] = phrase_list(DOC_PHRASES)
DOC_KEYWORDS = {
    "Tone": ["idiot", "moron", "trash", "stupid", "vile"],
    "Terms": ["license", "rights", "warranty", "copyright"],
    "Body": ["hand", "the heat", "ear"],
    "Function words": ["was", "nicht", "para", "elle"],
    "Praise": ["best", "great"],
}
DOC_VALENCES = {
    "trash": -3, "worthless": -3, "idiot": -3, "moron": -3, "loser": -2, "clown": -2,
    "stupid": -3, "pathetic": -3, "disgusting": -3, "vile": -3, "hate": -2, "hated": -2,
    "best": 3, "rest": 1, "heat": 1, "hand": 1, "thin": -1, "rent": -1, "ones": 1, "only": 1,
    "nicht": -1, "auch": 1, "mit": 1, "para": 1, "sur": -1, "pour": 1, "licensed": 1,
}

#: Declared column types of the driver's tables, so that reading starts no job.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
TABLES = tuple(SCHEMAS)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_themes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(feedback_id, product_id, inferred_themes) from the lines of each order."""
    bit_of = {t.code: 1 << i for i, t in enumerate(THEMES)}
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    parts = read(spark, sf_dir, "part").select("p_partkey", lookup(F.col("p_type"), bit_of).alias("bit"))
    rows = lines.join(parts, lines.l_partkey == parts.p_partkey, "left")
    # the set of themes as one integer: merged map-side, a few bytes per order
    grouped = rows.groupBy(F.col("l_orderkey").alias("feedback_id")).agg(
        F.min("l_partkey").alias("product_id"), F.bit_or(F.coalesce("bit", F.lit(0))).alias("mask")
    )
    codes = F.array(*[F.struct(F.lit(code).alias("code"), F.lit(bit).alias("bit")) for code, bit in bit_of.items()])
    present = F.filter(codes, lambda c: F.col("mask").bitwiseAND(c["bit"]) != 0)
    return grouped.select("feedback_id", "product_id", F.transform(present, lambda c: c["code"]).alias("found"))


def plain_feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feedback columns that come from orders alone."""
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("feedback_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("channel"),
        F.to_date("o_orderdate").alias("feedback_date"),
        lookup(F.col("o_orderstatus"), SENTIMENT_OF).alias("predicted_sentiment"),
        ((500 + (F.col("o_orderkey") * 37) % 501) / F.lit(1000.0)).alias("sentiment_confidence"),
        "o_totalprice",
    )


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All feedback columns; a message without any line has no product and no theme."""
    found = F.coalesce("found", F.array().cast("array<string>"))
    themes = F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(UNCLASSIFIED)))
    joined = plain_feedback(spark, sf_dir).join(order_themes(spark, sf_dir), "feedback_id", "left")
    return joined.withColumn("inferred_themes", themes).drop("found")


def labelled_feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feedback with its primary theme label, unscored."""
    return feedback(spark, sf_dir).withColumn("primary_theme", F.get("inferred_themes", 0)).withColumn(
        "theme_label_primary", lookup(F.col("primary_theme"), LABELS)
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("region"))
    tier = lookup(F.col("c_mktsegment"), TIER_OF)
    rows = read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), "c_nationkey",
        tier.alias("tier"), F.col("c_acctbal").alias("lifetime_value"),
    )
    return (
        rows.join(nation, rows.c_nationkey == nation.n_nationkey, "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select("customer_id", "region", "tier", "lifetime_value", lookup(F.col("tier"), CHURN_OF).alias("base_churn_prob"))
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_brand").alias("category"),
        F.col("p_retailprice").alias("price"),
        F.when(size <= 40, "normal").when(size <= 47, "elevated").otherwise("high").alias("quality_risk"),
    )


def aspect_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(feedback_id, theme, label): one label per message and theme."""
    lines = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"
    )
    parts = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    first = F.min(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"))
    return (
        lines.join(parts, "l_partkey")
        .groupBy(F.col("l_orderkey").alias("feedback_id"), F.col("p_type").alias("theme"))
        .agg(first.alias("first"))
        .select("feedback_id", "theme", lookup(F.col("first.l_returnflag"), SENTIMENT_OF_FLAG).alias("label"))
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", "text", "lang")


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that have labels, with a three-way truth and truth pairs."""
    toxic, good = F.col("toxic") == 1, F.col("quality") == 1
    truth = F.when(toxic, "negative").when(good, "positive").otherwise("neutral")
    pair = (
        F.when(toxic, F.array(_pair("insult", "negative"), _pair("filler", "neutral")))
        .when(good, F.array(_pair("praise", "positive")))
        .otherwise(F.array(_pair("rights", "neutral"), _pair("praise", "positive")))
    )
    labels = read(spark, sf_dir, "labels")
    return documents(spark, sf_dir).join(labels, "doc_id").select(
        "doc_id", "text", "lang", truth.alias("truth"), pair.alias("true_aspect_sentiments")
    )


def _pair(theme: str, sentiment: str):
    return F.struct(F.lit(theme).alias("theme"), F.lit(sentiment).alias("sentiment"))
