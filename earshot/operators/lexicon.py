"""Phrase lexicon over message text: hits, themes, aspects.

A lexicon is written by hand, so it travels inside the plan as one constant
array. Each message is matched where it is read: no join, no shuffle, nothing
collected. Phrases are matched as raw substrings of the lower-cased text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.catalogue import ASPECT_KEYWORDS, UNCLASSIFIED, Phrase
from earshot.functions.text import bind


def flatten_lexicon(
    nested: DataFrame, position: str = "position", theme: str = "theme", phrases: str = "phrases"
) -> DataFrame:
    """Rows of (position, theme, map sentiment -> phrases) as one row per phrase.

    The order of a phrase is (position, place of its sentiment, place in the
    list). A phrase listed twice keeps its first place and its last meaning.
    """
    by_sentiment = nested.select(
        F.col(position).cast("long").alias("p0"), F.col(theme).alias("theme"),
        F.posexplode(F.map_entries(phrases)).alias("p1", "entry"),
    )
    listed = by_sentiment.select(
        "p0", "p1", "theme", F.col("entry.key").alias("sentiment"),
        F.posexplode("entry.value").alias("p2", "text"),
    )
    place = F.struct("p0", F.col("p1").cast("long").alias("p1"), F.col("p2").cast("long").alias("p2"))
    return (
        listed.groupBy(F.lower("text").alias("phrase"))
        .agg(
            F.min(place).alias("first"),
            F.max_by(F.struct("theme", "sentiment"), place).alias("meaning"),
        )
        .select(
            F.col("first.p0").alias("theme_pos"),
            F.col("first.p1").alias("sentiment_pos"),
            F.col("first.p2").alias("phrase_pos"),
            "phrase", "meaning.theme", "meaning.sentiment",
        )
    )


def lexicon_hits(text: Column, lexicon: Sequence[Phrase], aspects: Mapping[str, str | None]) -> Column:
    """The entries whose phrase occurs in the text, in lexicon order.

    Array of (ord, phrase, theme, sentiment, aspect); ``aspect`` is null for
    themes that have none.
    """
    entries = F.array(
        *[
            F.struct(
                F.lit(ord_).alias("ord"),
                F.lit(p.text).alias("phrase"),
                F.lit(p.theme).alias("theme"),
                F.lit(p.sentiment).alias("sentiment"),
                F.lit(aspects.get(p.theme)).cast("string").alias("aspect"),
            )
            for ord_, p in enumerate(lexicon, start=1)
        ]
    )
    return bind(F.lower(text), lambda low: F.filter(entries, lambda e: F.contains(low, e["phrase"])))


def themes_of(hits: Column) -> Column:
    """Distinct themes in lexicon order; ``[unclassified]`` when nothing matched."""
    found = F.array_distinct(F.transform(hits, lambda h: h["theme"]))
    return bind(found, lambda f: F.when(F.size(f) > 0, f).otherwise(F.array(F.lit(UNCLASSIFIED))))


def aspects_of(hits: Column) -> Column:
    """(aspect, sentiment) pairs: the first hit places an aspect, the last labels it."""

    def pair(mapped: Column, name: Column) -> Column:
        last = F.try_element_at(F.filter(mapped, lambda h: h["aspect"] == name), F.lit(-1))
        return F.struct(name.alias("aspect"), F.initcap(last["sentiment"]).alias("sentiment"))

    def pairs(mapped: Column) -> Column:
        names = F.array_distinct(F.transform(mapped, lambda h: h["aspect"]))
        return F.transform(names, lambda name: pair(mapped, name))

    return bind(F.filter(hits, lambda h: h["aspect"].isNotNull()), pairs)


def keyword_aspects(text: Column, keywords: Mapping[str, Sequence[str]] = ASPECT_KEYWORDS) -> Column:
    """Aspects with a keyword in the text, each with its first listed match.

    Array of (ord, aspect, keyword).
    """
    entries = F.array(
        *[
            F.struct(
                F.lit(ord_).alias("ord"),
                F.lit(aspect).alias("aspect"),
                F.array(*[F.lit(w) for w in words]).alias("words"),
            )
            for ord_, (aspect, words) in enumerate(keywords.items(), start=1)
        ]
    )

    def match(low: Column) -> Column:
        tried = F.transform(
            entries,
            lambda e: F.struct(
                e["ord"].alias("ord"),
                e["aspect"].alias("aspect"),
                F.get(F.filter(e["words"], lambda w: F.contains(low, w)), 0).alias("keyword"),
            ),
        )
        return F.filter(tried, lambda e: e["keyword"].isNotNull())

    return bind(F.lower(text), match)


def tag_messages(
    messages: DataFrame, lexicon: Sequence[Phrase], aspects: Mapping[str, str | None], text: str = "text"
) -> DataFrame:
    """Adds detected_aspects, n_aspects_detected and inferred_themes."""
    hit = messages.withColumn("_hits", lexicon_hits(F.col(text), lexicon, aspects))
    tagged = hit.withColumn("detected_aspects", aspects_of(F.col("_hits")))
    return (
        tagged.withColumn("n_aspects_detected", F.size("detected_aspects"))
        .withColumn("inferred_themes", themes_of(F.col("_hits")))
        .drop("_hits")
    )
