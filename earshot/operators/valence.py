"""Rule-based sentiment: token valences summed and squashed to [-1, 1]."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.catalogue import ASPECT_KEYWORDS
from earshot.functions.labels import valence_label
from earshot.functions.text import WORDS, clauses, tokens
from earshot.operators.lexicon import keyword_aspects

#: Decimal places a valence may have: sums are exact, whatever the order of rows.
VALENCE_DIGITS = 9
#: Largest valence table that is sent to every executor; above it Spark decides.
BROADCAST_WORDS = 200_000


def valence_table(spark: SparkSession, valences: Mapping[str, float]) -> DataFrame:
    """Word -> valence in units of the last place. Hinted for broadcast only below a counted size."""
    rows = []
    for word, value in valences.items():
        points = Decimal(repr(value)).scaleb(VALENCE_DIGITS)
        if points != int(points):
            raise ValueError(f"the valence {value!r} of {word!r} has more than {VALENCE_DIGITS} decimals")
        rows.append((word, int(points)))
    table = spark.createDataFrame(rows, "token string, points long")
    return F.broadcast(table) if len(rows) <= BROADCAST_WORDS else table


def normalise(total: Column, alpha: float = 15.0) -> Column:
    """Sum of valences to the open interval (-1, 1)."""
    return total / F.sqrt(total * total + F.lit(alpha))


def valence_scores(
    texts: DataFrame, keys: Sequence[str], text: Column, table: DataFrame, pattern: str = WORDS
) -> DataFrame:
    """One row per key: (keys, total, compound, label).

    Tokens are summed where they are read; only (keys, sum) is shuffled, never
    the text. A text without any known word scores zero.
    """
    words = texts.select(*keys, F.explode_outer(tokens(text, pattern)).alias("token"))
    scored = words.join(table, "token", "left")
    summed = scored.groupBy(*keys).agg(F.sum(F.coalesce("points", F.lit(0))).alias("points"))
    total = F.col("points").cast("double") / F.lit(float(10**VALENCE_DIGITS))
    out = summed.select(*keys, total.alias("total"))
    out = out.withColumn("compound", normalise(F.col("total")))
    return out.withColumn("label", valence_label(F.col("compound")))


def label_rows(
    rows: DataFrame, key: str, text: str, table: DataFrame, pattern: str = WORDS, out: str = "predicted_sentiment"
) -> DataFrame:
    """``rows`` with the rule-based label of each row's own text, null and repeated keys included.

    Rows are met again by key and digest of the text. Rows that agree in both add up to a
    multiple of one row's sum, so the sum is divided by their number.
    """
    marked = rows.withColumn("_digest", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    words = marked.select(
        F.col(key).alias("_key"), F.col("_digest").alias("_of"), F.posexplode_outer(tokens(F.col(text), pattern)).alias("_at", "token")
    )
    sums = words.join(table, "token", "left").groupBy("_key", "_of").agg(
        F.sum(F.coalesce("points", F.lit(0))).alias("points"), F.count_if(F.coalesce("_at", F.lit(0)) == 0).alias("copies")
    )
    total = F.col("points").cast("double") / F.col("copies") / F.lit(float(10**VALENCE_DIGITS))
    named = sums.select("_key", "_of", valence_label(normalise(total)).alias(out))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_digest") == F.col("_of"))
    return marked.join(named, same, "left").drop("_key", "_of", "_digest")


def keyword_clauses(
    messages: DataFrame,
    key: str,
    text: str = "text",
    keywords: Mapping[str, Sequence[str]] = ASPECT_KEYWORDS,
) -> DataFrame:
    """(key, ord, aspect, keyword, clause): the first clause that holds the keyword.

    A keyword that straddles two clauses stands for the whole text.
    """
    found = messages.select(
        key, text,
        clauses(F.col(text)).alias("_clauses"),
        keyword_aspects(F.col(text), keywords).alias("_aspects"),
    )
    each = found.select(key, text, "_clauses", F.inline("_aspects"))
    holding = F.filter("_clauses", lambda c: F.contains(F.lower(c), F.col("keyword")))
    return each.select(
        key, "ord", "aspect", "keyword", F.coalesce(F.get(holding, 0), F.col(text)).alias("clause")
    )


def clause_aspects(
    messages: DataFrame,
    key: str,
    table: DataFrame,
    text: str = "text",
    keywords: Mapping[str, Sequence[str]] = ASPECT_KEYWORDS,
    pattern: str = WORDS,
) -> DataFrame:
    """Keyword aspects with the sentiment of their clause: (key, ord, aspect, label)."""
    found = keyword_clauses(messages, key, text, keywords)
    scores = valence_scores(found, [key, "ord", "aspect"], F.col("clause"), table, pattern)
    return scores.select(key, "ord", "aspect", "compound", "label")
