"""Large phrase lexicons: word n-grams of the messages, joined to a phrase table by hash.

The mode for lexicons that are too long to test phrase by phrase (see
``lexicon.lexicon_hits``). It matches **whole words**: message and phrase are cut into
words by one pattern, in lower case, and a phrase occurs where its words stand one after
another in the message, whatever lies between two words. So ``app`` is not found in
"happy", and "late - delivery" holds the phrase ``late delivery``.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.catalogue import UNCLASSIFIED
from earshot.functions.labels import lookup
from earshot.functions.text import WORDS, bind, tokens
from earshot.operators.lexicon import aspects_of, themes_of
from earshot.session import scratch_dir

#: Rows of a phrase table that are broadcast; a longer one is joined by a shuffle.
BROADCAST_PHRASES = 500_000

#: Characters of messages whose hits one task gathers, so that its memory does not grow with the table.
TASK_CHARS = 6_000_000

#: Characters of messages that are looked up at a time in a phrase table that is not broadcast, so that the disk that
#: their n-grams and hits are shuffled through does not grow with the table.
ROUND_CHARS = 400_000_000


def phrase_table(
    lexicon: DataFrame, aspects: Mapping[str, str | None] | None = None, pattern: str = WORDS
) -> DataFrame:
    """(phrase, first, length, ord, theme, sentiment, aspect) of (ord, phrase, theme, sentiment).

    Phrases of the same words are one: it keeps its first place and its last meaning. A
    phrase without a word matches nothing and is left out. Without ``aspects`` all aspects are null.
    """
    # equal rows first, by hash: only different ones are cut into words and sorted
    rows = lexicon.groupBy("phrase", "theme", "sentiment").agg(F.min("ord").alias("ord"), F.max("ord").alias("last"))
    words = rows.select("ord", "last", "theme", "sentiment", tokens(F.col("phrase"), pattern).alias("words"))
    merged = words.where(F.size("words") > 0).groupBy("words").agg(
        F.min("ord").alias("ord"), F.max_by(F.struct("theme", "sentiment"), F.col("last")).alias("meaning")
    )
    known = {theme: aspect for theme, aspect in (aspects or {}).items() if aspect is not None}
    aspect = lookup(F.col("meaning.theme"), known) if known else F.lit(None).cast("string")
    return merged.select(
        F.array_join("words", " ").alias("phrase"), F.get("words", 0).alias("first"),
        F.size("words").alias("length"), "ord", "meaning.theme", "meaning.sentiment", aspect.alias("aspect"),
    )


def _small(table: DataFrame, most: int) -> DataFrame:
    return F.broadcast(table) if table.agg(F.count(F.lit(1))).first()[0] <= most else table


def _write(rows: DataFrame, path: str) -> None:
    """Writes ``rows``; what was shuffled to make them is given up as soon as they are there."""
    rows.write.parquet(path)
    # shuffle files go when the driver collects the plan that wrote them, which may be long after
    rows.sparkSession.sparkContext._jvm.System.gc()


def _written(rows: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(rows.sparkSession, label)
    _write(rows, path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _chars(rows: DataFrame, text: str) -> int:
    return rows.agg(F.sum(F.length(text))).first()[0] or 0


def _tasks(spark: SparkSession, chars: int, task_chars: int) -> int:
    return max(spark.sparkContext.defaultParallelism, math.ceil(chars / task_chars))


def by_key(messages: DataFrame, keys: Sequence[str], text: str, task_chars: int = TASK_CHARS) -> DataFrame:
    """(keys, text), rows of equal keys in one task, in as many tasks as the text asks for.

    The messages are written once: their length is measured on what is read again.
    """
    rows = _written(messages.select(*keys, text), "messages")
    return rows.repartition(_tasks(rows.sparkSession, _chars(rows, text), task_chars), *keys)


def word_hits(
    messages: DataFrame, keys: Sequence[str], text: str, phrases: DataFrame, pattern: str = WORDS,
    broadcast_rows: int = BROADCAST_PHRASES, task_chars: int | None = TASK_CHARS,
) -> DataFrame:
    """(keys, ord, phrase, theme, sentiment, aspect): the phrases of each message, each once.

    Every word of a message is a possible start and carries as many words as the longest phrase has.
    Starts that begin no phrase fall at the first join, against the phrases' first
    words; from the others n-grams are cut in the lengths that follow their first word,
    and the second join looks these up. Both joins are by equality: up to
    ``broadcast_rows`` phrases only the messages are shuffled, by their keys, beyond that Spark also
    shuffles by word and by phrase. Rows that share their keys count as one message. Without
    ``task_chars`` the messages lie by key already and are taken as they lie.
    """
    if task_chars is not None:
        messages = by_key(messages, keys, text, task_chars)
    longest = phrases.agg(F.max("length")).first()[0] or 1
    starts = phrases.groupBy(F.col("first").alias("_first")).agg(F.collect_set("length").alias("_lengths"))

    def runs(words: Column) -> Column:
        return F.transform(words, lambda _, at: F.slice(words, at + 1, longest))

    cut = messages.select(*keys, F.explode(bind(tokens(F.col(text), pattern), runs)).alias("_run"))
    cut = cut.withColumn("_word", F.get("_run", 0))
    begun = cut.join(_small(starts, broadcast_rows), F.col("_word") == F.col("_first"))
    grams = begun.select(*keys, "_run", F.explode("_lengths").alias("_n")).where(F.size("_run") >= F.col("_n"))
    grams = grams.select(*keys, F.array_join(F.slice("_run", 1, F.col("_n")), " ").alias("_gram"))
    table = phrases.select("ord", "phrase", "theme", "sentiment", "aspect")
    found = grams.distinct().join(_small(table, broadcast_rows), F.col("_gram") == F.col("phrase"))
    return found.select(*keys, "ord", "phrase", "theme", "sentiment", "aspect")


def tag_messages_by_words(
    messages: DataFrame, key: str, phrases: DataFrame, text: str = "text", pattern: str = WORDS,
    broadcast_rows: int = BROADCAST_PHRASES, task_chars: int = TASK_CHARS, round_chars: int = ROUND_CHARS,
) -> DataFrame:
    """Adds detected_aspects, n_aspects_detected and inferred_themes, as ``lexicon.tag_messages`` does.

    The hits of a message, at most one per phrase, are turned into aspects and themes where they
    are found. Messages are dealt by their key in the same way, so that neither hits nor tags
    are shuffled to meet them. Null keys meet each other. Messages that are nothing but key and text are not made twice.
    Beyond ``broadcast_rows`` phrases n-grams and hits have to be shuffled: then messages are tagged in rounds
    of some ``round_chars`` characters, each of which leaves only its tags on disk.
    """
    spark = messages.sparkSession
    phrases = _written(phrases.select("phrase", "first", "length", "ord", "theme", "sentiment", "aspect"), "phrases")
    kept = _written(messages.select(F.col(key).alias("_id"), F.col(text).alias("_text")), "messages")
    chars = _chars(kept, "_text")
    tasks = _tasks(spark, chars, task_chars)
    # a struct equals itself whether or not its field is null, so that a plain equality joins it
    keyed = kept.select(F.struct("_id").alias("_key"), "_text")
    order = ["ord", "phrase"]
    if phrases.count() <= broadcast_rows:
        hits = word_hits(keyed.repartition(tasks, "_key"), ["_key"], "_text", phrases, pattern, broadcast_rows, None)
        tags = _tags(hits, order)
    else:
        if phrases.groupBy("ord").count().where("count > 1").isEmpty():
            order = ["ord"]  # phrases are long, and these hits are shuffled
        rounds = max(1, math.ceil(chars / round_chars))
        some = _tasks(spark, math.ceil(chars / rounds), task_chars)
        path = scratch_dir(spark, "tags")
        for i in range(rounds):
            dealt = keyed.where(F.pmod(F.xxhash64("_key"), F.lit(rounds)) == i).repartition(some, "_key")
            hits = word_hits(dealt, ["_key"], "_text", phrases, pattern, broadcast_rows, None)
            tags = _tags(hits.repartition(some, "_key"), order)
            _write(tags, f"{path}/{i}")
        tags = spark.read.schema(tags.schema).parquet(*[f"{path}/{i}" for i in range(rounds)]).repartition(tasks, "_key")
    whole = messages
    if sorted(messages.columns) == sorted((key, text)):
        whole = kept.select(F.col("_id").alias(key), F.col("_text").alias(text)).select(*messages.columns)
    rows = whole.withColumn("_key", F.struct(F.col(key).alias("_id"))).repartition(tasks, "_key")
    none = F.array().cast(tags.schema["_aspects"].dataType)
    return (
        rows.join(tags, "_key", "left").drop("_key")
        .withColumn("detected_aspects", F.coalesce("_aspects", none))
        .withColumn("n_aspects_detected", F.size("detected_aspects"))
        .withColumn("inferred_themes", F.coalesce("_themes", F.array(F.lit(UNCLASSIFIED))))
        .drop("_aspects", "_themes")
    )


def _tags(hits: DataFrame, order: Sequence[str]) -> DataFrame:
    """(_key, _aspects, _themes) of each key's hits, taken by ``order``."""
    entry = F.struct(*order, "theme", "sentiment", "aspect")
    listed = hits.groupBy("_key").agg(F.array_sort(F.collect_list(entry)).alias("_hits"))
    return listed.select("_key", aspects_of(F.col("_hits")).alias("_aspects"), themes_of(F.col("_hits")).alias("_themes"))
