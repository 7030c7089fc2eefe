"""Token counts against the library on whole texts."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from earshot.llm.queries import tokenizer_file
from earshot.llm.token_counts import CutCounter, can_be_cut, frequent_lengths, token_counts

PATH = "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def counters():
    import sentencepiece

    path = tokenizer_file(PATH)
    return CutCounter(path, {"the": CutCounter(path, {})["the"]}, keep=2000), sentencepiece.SentencePieceProcessor(model_file=path)


ODD = [
    "", " ", "  ", "\n", " \n ", "\n a", "a\n", "a \nb\n\n c", "▁", "a▁b ▁ c", "▁▁\n▁x", "\r\n;\r\n x", "\t\tif x:\n\t\t  y", "\x00a\x00 b",
    "<s> </s> <unk> <0x0A>", "é e\u0301 漢字 😀 \u2028 \u00a0", "a" * 2000, "0123456789 1 2", "   leading and trailing   ",
]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(counters, text):
    own, library = counters
    assert own.count(text) == len(library.encode(text))


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="ab ▁\n\r;é", max_size=40)))
def test_any_text(counters, text):
    own, library = counters
    assert own.count(text) == len(library.encode(text))


def test_the_model_can_be_cut():
    assert can_be_cut(tokenizer_file(PATH))


def test_query_columns_and_nulls(spark):
    rows = [(1, "one two", 5), (2, None, 5), (3, "", 5), (None, "x", 5), (1, "é" * 9000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    got = sorted(map(tuple, token_counts(docs, tokenizer_file(PATH)).collect()), key=str)
    own = CutCounter(tokenizer_file(PATH), {})
    want = [(i, len((t or "").encode()), own.count(t), own.count(t) > 4096) for i, t, _ in rows]
    assert got == sorted(want, key=str)
    assert token_counts(docs.limit(0), tokenizer_file(PATH)).count() == 0


def test_the_first_tier_is_of_the_whole_corpus(spark):
    rows = [(i, "alpha beta " * 3) for i in range(900)] + [(i, "tail " * 9000 + "é" * 70 + " " + "é" * 70) for i in (900, 901)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    path = tokenizer_file(PATH)
    assert {"alpha", "beta", "tail"} <= set(frequent_lengths(docs, path))
    assert frequent_lengths(docs, path, entries=1) == {}  # no name is all of the corpus
    assert set(frequent_lengths(docs, path, entries=3)) == {"tail"}
    own = CutCounter(path, {})
    assert all(frequent_lengths(docs, path)[k] == own[k] for k in ("alpha", "tail"))
    assert not any("é" in k for k in frequent_lengths(docs, path))
    assert frequent_lengths(docs.limit(0), path) == {}


def test_the_cache_is_bounded_by_characters():
    counter = CutCounter(tokenizer_file(PATH), {"a": 1}, keep=5000)
    for i in range(300):
        counter.count(f"{i} " + "xy" * 1500 + str(i))
        assert sum(len(k) + 64 for k in counter if k != "a") <= 5000 and counter["a"] == 1
    assert counter.count("z" * 9000) == len(counter.model.encode("z" * 9000))
