from pyspark.sql import functions as F

from earshot import catalogue as c
from earshot.functions.labels import majority_label, tier_of, valence_label
from earshot.functions.text import clauses, joined_pairs, split_list, split_pairs, tokens, word_grams
from earshot.operators.agreement import aspect_agreement
from earshot.operators.lexicon import aspects_of, flatten_lexicon, keyword_aspects, lexicon_hits, tag_messages, themes_of
from earshot.operators.valence import clause_aspects, keyword_clauses, label_rows, valence_scores, valence_table

LEXICON = [
    c.Phrase("slow app", "app", "negative"),
    c.Phrase("paid twice", "general_pay", "neutral"),
    c.Phrase("nice box", "box", "positive"),
    c.Phrase("charged twice", "double_pay", "negative"),
    c.Phrase("lovely", "mood", "positive"),
    c.Phrase("app crash", "app", "positive"),
]
ASPECTS = {"app": "App", "general_pay": "Payment", "double_pay": "Payment", "box": "Box", "mood": None}


def texts(spark, *rows):
    return spark.createDataFrame(list(enumerate(rows, start=1)), "id int, text string")


def only(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_themes_follow_lexicon_order_not_text_order(spark):
    row = only(tag_messages(texts(spark, "I was CHARGED twice, with a nice box and a slow app"), LEXICON, ASPECTS))
    assert row.inferred_themes == ["app", "box", "double_pay"]


def test_last_hit_labels_an_aspect_and_first_hit_places_it(spark):
    row = only(tag_messages(texts(spark, "charged twice, nice box, paid twice"), LEXICON, ASPECTS))
    assert [tuple(a) for a in row.detected_aspects] == [("Payment", "Negative"), ("Box", "Positive")]
    assert row.n_aspects_detected == 2
    row = only(tag_messages(texts(spark, "app crash after slow app"), LEXICON, ASPECTS))
    assert [tuple(a) for a in row.detected_aspects] == [("App", "Positive")]


def test_theme_without_aspect(spark):
    row = only(tag_messages(texts(spark, "lovely"), LEXICON, ASPECTS))
    assert row.inferred_themes == ["mood"] and row.detected_aspects == []


def test_no_match_is_unclassified(spark):
    row = only(tag_messages(texts(spark, "nothing here"), LEXICON, ASPECTS))
    assert row.inferred_themes == ["unclassified"] and row.n_aspects_detected == 0


def test_keywords_match_inside_words(spark):
    found = only(texts(spark, "so happy").select(keyword_aspects(F.col("text")).alias("a"))).a
    assert [(x.aspect, x.keyword) for x in found] == [("App/Website", "app")]


def test_first_listed_keyword_wins_over_text_order(spark):
    found = only(texts(spark, "arrived by shipping").select(keyword_aspects(F.col("text")).alias("a"))).a
    assert [(x.aspect, x.keyword) for x in found] == [("Delivery", "shipping")]


def test_catalogue_lexicon(spark):
    phrases = c.phrase_list()
    assert len(phrases) == 71
    assert phrases[0] == c.Phrase("delivery took way longer than promised", "delivery_delay", "negative")
    assert {p.theme for p in phrases} == {t.code for t in c.THEMES}
    assert not any(a.text in b.text for a in phrases for b in phrases if a is not b)
    hits = lexicon_hits(F.col("text"), phrases, {t.code: t.aspect for t in c.THEMES})
    row = only(
        texts(spark, "I was charged twice for the same order and no refund yet. However the app is smooth and easy to use")
        .select(themes_of(hits).alias("themes"), aspects_of(hits).alias("aspects"))
    )
    assert row.themes == ["app_performance", "payment_double_charge"]
    assert [tuple(a) for a in row.aspects] == [("App/Website", "Positive"), ("Payment", "Negative")]


def test_duplicate_phrase_keeps_place_and_takes_last_meaning(spark):
    nested = {"a": {"negative": ["One", "two"]}, "b": {"positive": ["one"]}}
    assert c.phrase_list(nested) == [c.Phrase("one", "b", "positive"), c.Phrase("two", "a", "negative")]
    frame = spark.createDataFrame(
        [(0, "a", {"negative": ["One", "two"]}), (1, "b", {"positive": ["one"]})],
        "position long, theme string, phrases map<string,array<string>>",
    )
    rows = flatten_lexicon(frame).orderBy("theme_pos", "sentiment_pos", "phrase_pos").collect()
    assert [(r.phrase, r.theme, r.sentiment) for r in rows] == [("one", "b", "positive"), ("two", "a", "negative")]


def test_clauses(spark):
    text = "It works. But slow!  Really however fine but ok, butter stays"
    row = only(texts(spark, text).select(clauses(F.col("text")).alias("c")))
    assert row.c == ["It works.", "But slow!", "Really", "however fine", "but ok, butter stays"]
    assert only(texts(spark, "   ").select(clauses(F.col("text")).alias("c"))).c == []


def test_clause_of_a_keyword(spark):
    df = texts(spark, "The app is great. But delivery was awful", "money back. and fore. ver")
    rows = {(r.id, r.aspect): r.clause for r in keyword_clauses(df, "id").collect()}
    assert rows[(1, "Delivery")] == "But delivery was awful"
    assert rows[(1, "App/Website")] == "The app is great."
    straddle = keyword_clauses(texts(spark, "one. but two"), "id", keywords={"X": ["one. but"]})
    assert only(straddle).clause == "one. but two"


def test_clause_sentiment_differs_from_the_whole_text(spark):
    table = valence_table(spark, {"great": 3.0, "awful": -3.5})
    rows = {
        r.aspect: r.label
        for r in clause_aspects(texts(spark, "The app is great. But delivery was awful"), "id", table).collect()
    }
    assert rows == {"App/Website": "positive", "Delivery": "negative"}


def test_valence_scores(spark):
    table = valence_table(spark, {"good": 1.9, "bad": -2.5})
    df = texts(spark, "good GOOD bad", "nothing", "", None)
    rows = {r.id: r for r in valence_scores(df, ["id"], F.col("text"), table).collect()}
    assert abs(rows[1].total - 1.3) < 1e-12
    assert abs(rows[1].compound - 1.3 / (1.3**2 + 15) ** 0.5) < 1e-12
    assert [rows[i].label for i in (1, 2, 3, 4)] == ["positive", "neutral", "neutral", "neutral"]


def test_label_borders(spark):
    df = spark.createDataFrame([(0.05,), (0.0499,), (-0.05,), (-0.0499,)], "x double")
    assert [r[0] for r in df.select(valence_label(F.col("x"))).collect()] == ["positive", "neutral", "negative", "neutral"]


def test_tier_borders(spark):
    scores = [24.9, 25.0, 44.9, 45.0, 64.9, 65.0, None]
    df = spark.createDataFrame([(s,) for s in scores], "x double")
    got = [r[0] for r in df.select(tier_of(F.col("x"))).collect()]
    assert got == ["Low", "Medium", "Medium", "High", "High", "Critical", "Low"]


def test_majority_vote(spark):
    cases = {
        (1, 1, 1): "negative", (0, 2, 1): "neutral", (0, 1, 2): "positive", (1, 2, 0): "neutral",
        (1, 0, 2): "positive", (0, 1, 1): "neutral", (2, 1, 1): "negative", (0, 0, 1): "positive",
    }
    df = spark.createDataFrame(list(cases), "n int, u int, p int")
    got = {(r.n, r.u, r.p): r.v for r in df.select("*", majority_label(F.col("n"), F.col("u"), F.col("p")).alias("v")).collect()}
    assert got == cases


def test_list_text_round_trip(spark):
    row = only(
        spark.createDataFrame([("a:x|b:y",)], "s string")
        .select(split_pairs(F.col("s")).alias("p"), split_list(F.lit("a|b")).alias("l"))
        .select("*", joined_pairs(F.col("p")).alias("back"))
    )
    assert [tuple(p) for p in row.p] == [("a", "x"), ("b", "y")] and row.l == ["a", "b"] and row.back == "a:x|b:y"


def test_word_grams(spark):
    words = tokens(F.col("text"))
    grams = texts(spark, "One two three", "solo", "a").select(word_grams(words, 3).alias("g")).collect()
    assert grams[0].g == ["one", "two", "three", "one two", "two three", "one two three"]
    assert grams[1].g == ["solo"] and grams[2].g == []


def test_agreement_skips_themes_without_aspect(spark):
    kind = "array<struct<theme:string,sentiment:string>>"
    df = spark.createDataFrame(
        [
            ([("app", "negative"), ("mood", "positive")], [("App", "Negative")]),
            ([("box", "neutral"), ("double_pay", "negative")], [("Box", "Positive")]),
            ([("mood", "positive")], []),
        ],
        f"true_aspect_sentiments {kind}, detected_aspects array<struct<aspect:string,sentiment:string>>",
    )
    row = only(aspect_agreement(df, ASPECTS))
    assert (row.correct, row.total) == (1, 3) and abs(row.agreement - 1 / 3) < 1e-12


def test_row_labels_with_null_and_repeated_keys(spark):
    rows = [(None, "good good"), (None, "bad"), (1, "good"), (1, "bad"), (2, None), (3, "good"), (3, "good"), (4, "")]
    df = spark.createDataFrame([(*r, "own") for r in rows], "id long, text string, token string")
    table = valence_table(spark, {"good": 2.0, "bad": -2.0})
    got = sorted(tuple(r) for r in label_rows(df, "id", "text", table).na.fill(-1, ["id"]).na.fill("").collect())
    label = {"good good": "positive", "good": "positive", "bad": "negative"}
    want = sorted((-1 if i is None else i, t or "", "own", label.get(t, "neutral")) for i, t in rows)
    assert got == want
