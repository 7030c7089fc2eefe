"""Word-aligned phrases against a plain search, and the shape of the plan."""

import re

import pytest
from pyspark.sql import functions as F

from earshot.catalogue import Phrase
from earshot.checks.queries import order_texts
from earshot.operators.phrases import by_key, phrase_table, tag_messages_by_words, word_hits
from earshot.plans import chain
from earshot.sources.tables import lexicon_frame

LEXICON = [
    Phrase("late delivery", "ship", "negative"), Phrase("late", "ship", "neutral"), Phrase("Delivery, late", "ship", "positive"),
    Phrase("app", "tech", "negative"), Phrase("app app", "tech", "positive"), Phrase("LATE  delivery", "price", "positive"),
    Phrase("the late delivery of the app", "tech", "negative"), Phrase("!!", "none", "neutral"), Phrase("ünïcode wörd", "tech", "neutral"),
]
ASPECTS = {"ship": "Delivery", "tech": "App", "price": None}
MESSAGES = [
    (1, "Late - delivery!"), (2, "happy lately"), (3, "The late delivery of the app app app"), (4, None), (5, ""), (6, "late"),
    (7, "Ünïcode wörd; delivery\nlate"), (None, "an app"), (None, "late"), (8, "app"), (8, "delivery, late"), (9, "!!"),
]


def plainly(rows, lexicon):
    def words(text):
        return re.findall(r"\b\w\w+\b", (text or "").lower())

    table = {}
    for ord_, p in enumerate(lexicon, start=1):
        key = tuple(words(p.text))
        if key:
            table[key] = (table.get(key, (ord_,))[0], p.theme, p.sentiment)
    out = set()
    for i, text in rows:
        w = words(text)
        for key, (ord_, theme, sentiment) in table.items():
            if any(tuple(w[at : at + len(key)]) == key for at in range(len(w))):
                out.add((i, ord_, " ".join(key), theme, sentiment, ASPECTS.get(theme)))
    return out


@pytest.mark.parametrize("broadcast_rows", [500_000, 0])
def test_equals_a_plain_search(spark, broadcast_rows):
    messages = spark.createDataFrame([(*r, "own") for r in MESSAGES], "id long, text string, ord string")
    phrases = phrase_table(lexicon_frame(spark, LEXICON), ASPECTS)
    assert phrases.count() == 7  # one pair of equal words, one without words
    hits = word_hits(messages, ["id"], "text", phrases, broadcast_rows=broadcast_rows)
    got = [tuple(r) for r in hits.collect()]
    assert len(got) == len(set(got)) and set(got) == plainly(MESSAGES, LEXICON)


def test_tags_keep_every_row_and_its_columns(spark):
    messages = spark.createDataFrame([(*r, "own") for r in MESSAGES], "id long, text string, phrase string")
    tagged = tag_messages_by_words(messages, "id", phrase_table(lexicon_frame(spark, LEXICON), ASPECTS))
    assert tagged.columns == ["id", "text", "phrase", "detected_aspects", "n_aspects_detected", "inferred_themes"]
    rows = tagged.collect()
    assert len(rows) == len(MESSAGES) and {r.phrase for r in rows} == {"own"}
    by_id = {r.id: r for r in rows}
    assert by_id[2].inferred_themes == by_id[4].inferred_themes == by_id[9].inferred_themes == ["unclassified"]
    assert by_id[1].inferred_themes == ["price", "ship"]  # the first place of "late delivery", its last meaning
    assert [tuple(a) for a in by_id[3].detected_aspects] == [("Delivery", "Neutral"), ("App", "Negative")]


def test_empty_sides(spark):
    messages = spark.createDataFrame([(1, "late")], "id long, text string")
    phrases = phrase_table(lexicon_frame(spark, LEXICON), ASPECTS)
    assert word_hits(messages.limit(0), ["id"], "text", phrases).count() == 0
    assert word_hits(messages, ["id"], "text", phrases.limit(0)).count() == 0
    assert phrase_table(lexicon_frame(spark, LEXICON)).where("aspect IS NOT NULL").count() == 0


def test_joins_are_by_hash(spark):
    messages = spark.createDataFrame([(1, "late")], "id long, text string")
    phrases = phrase_table(lexicon_frame(spark, LEXICON), ASPECTS)
    for rows in (500_000, 0):
        plan = word_hits(messages, ["id"], "text", phrases, broadcast_rows=rows)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
        assert ("SortMergeJoin" in plan) != (rows > 0)


def test_the_chain_takes_the_mode(spark):
    messages = spark.createDataFrame([("1", "late delivery")], "feedback_id string, text string")
    settings = chain.Settings(lexicon=LEXICON, phrase_match="words")
    assert chain.tag_aspects(messages, settings).first()["inferred_themes"] == ["price", "ship"]
    with pytest.raises(ValueError):
        chain.tag_aspects(messages, chain.Settings(phrase_match="fuzzy"))
    plain = chain.tag_aspects(messages.select("feedback_id", F.lit("nothing").alias("text")), chain.Settings())
    assert plain.first()["n_aspects_detected"] == 0


def test_tasks_grow_in_number_with_the_text(spark):
    messages = spark.range(3000).selectExpr("id % 1000 AS id", "'the late delivery' AS text")
    cores = spark.sparkContext.defaultParallelism
    assert by_key(messages, ["id"], "text").rdd.getNumPartitions() == cores
    rows = by_key(messages, ["id"], "text", task_chars=1000)
    assert rows.rdd.getNumPartitions() == 51  # 3000 x 17 characters
    where = rows.select("id", F.spark_partition_id().alias("part")).distinct()
    assert where.count() == 1000  # the rows of a key lie together
    phrases = phrase_table(lexicon_frame(spark, LEXICON), ASPECTS)
    hits = word_hits(messages, ["id"], "text", phrases, task_chars=1000)
    assert hits.count() == hits.distinct().count() == 2000  # "late" and "late delivery" of each key


def test_equal_phrases_are_merged_before_they_are_cut(spark):
    rows = [(3, "late", "a", "neutral"), (1, "late", "a", "neutral"), (2, "LATE", "b", "neutral"), (None, "app", "c", None), (5, None, "d", "x")]
    table = phrase_table(spark.createDataFrame(rows * 2, "ord int, phrase string, theme string, sentiment string"))
    assert {tuple(r)[:1] + tuple(r)[3:5] for r in table.collect()} == {("late", 1, "a"), ("app", None, None)}
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[phrase" in plan


def test_hits_are_not_shuffled_to_their_messages(spark):
    phrases = phrase_table(lexicon_frame(spark, LEXICON), ASPECTS)
    for rows in (MESSAGES, [(*r, "own") for r in MESSAGES]):
        messages = spark.createDataFrame(rows, "id long, text string, own string" if len(rows[0]) == 3 else "id long, text string")
        plan = tag_messages_by_words(messages, "id", phrases)._jdf.queryExecution().executedPlan().toString()
        dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(_key" in line or "Exchange hashpartitioning(coalesce(_key" in line]
        assert len(dealt) == 2 and all("REPARTITION_BY_NUM" in line for line in dealt)  # texts once, rows once


def test_messages_of_key_and_text_are_made_once(spark):
    phrases = phrase_table(lexicon_frame(spark, LEXICON), ASPECTS)
    made = spark.range(40).groupBy(F.when(F.col("id") % 10 > 0, F.col("id") % 10).alias("id")).agg(F.concat(F.lit("late "), F.max("id")).alias("text"))
    tagged = tag_messages_by_words(made.select("text", "id"), "id", phrases)
    assert "Range" not in tagged._jdf.queryExecution().optimizedPlan().toString()
    assert tagged.columns == ["text", "id", "detected_aspects", "n_aspects_detected", "inferred_themes"]
    rows = {r.id: r for r in tagged.collect()}
    assert rows.keys() == {None, *range(1, 10)} and rows[None].text == "late 30" and rows[7].text == "late 37"
    assert {(r.n_aspects_detected, *r.inferred_themes) for r in rows.values()} == {(1, "ship")}


def test_long_lexicons_are_looked_up_in_rounds(spark):
    # two phrases of one place, and two without a place, are ordered by their words
    twice = [(2, "app app", "b", "positive"), (2, "the app", "a", "negative"), (None, "late", "c", "neutral"), (None, "app", "a", "neutral")]
    lexicons = [lexicon_frame(spark, LEXICON), spark.createDataFrame(twice, "ord int, phrase string, theme string, sentiment string")]
    messages = spark.createDataFrame([(*r, "own") for r in MESSAGES], "id long, text string, phrase string")
    for lexicon in lexicons:
        phrases = phrase_table(lexicon, ASPECTS | {"a": "A", "b": "B", "c": "C"})
        few = tag_messages_by_words(messages, "id", phrases).collect()
        many = tag_messages_by_words(messages, "id", phrases, broadcast_rows=0, round_chars=20)
        plan = many._jdf.queryExecution().executedPlan().toString()
        assert "_text" not in plan and "_gram" not in plan  # the rounds have run, only tags are left
        assert sorted(map(repr, many.collect())) == sorted(map(repr, few)) and len(few) == len(MESSAGES)


def test_rounds_hold_every_message_once(spark):
    phrases = phrase_table(lexicon_frame(spark, LEXICON), ASPECTS)
    messages = spark.range(2000).selectExpr("id % 700 AS id", "IF(id % 3 = 0, 'the late delivery', IF(id % 3 = 1, 'app', 'none')) AS text")
    tags = tag_messages_by_words(messages, "id", phrases, broadcast_rows=0, round_chars=5000)
    assert len(tags.inputFiles()) > 8 and tags.count() == 2000
    plain = tag_messages_by_words(messages, "id", phrases)
    assert tags.exceptAll(plain).isEmpty() and plain.exceptAll(tags).isEmpty()
    empty = tag_messages_by_words(messages.limit(0), "id", phrases, broadcast_rows=0)
    assert empty.count() == 0 and empty.schema == tags.schema


def test_lines_are_listed_after_their_shuffle(spark, sf_dir):
    plan = order_texts(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()  # the last step stands first
    assert plan.count("Exchange hashpartitioning(l_orderkey") == 1
    assert 0 < plan.index("partial_collect_list") < plan.index("Exchange hashpartitioning(l_orderkey")
