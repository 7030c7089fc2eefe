"""Packing against the library's own ids, and differencing by property."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from earshot.llm.packing import WordEncoder, differencing, pack, spread
from earshot.llm.queries import tokenizer_file


@pytest.fixture(scope="module")
def encoders():
    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    return WordEncoder(path, keep=1000), Tokenizer.from_file(path)


ODD = [
    "", " ", "\n\n", "Don't stop, I'LL go; we're they've I'm she'd it's", "<|endoftext|> a<|startoftext|>b", "ÀÉÎ straße ÿ ß µ ª º ² ¼",
    "e\u0301 \u0301x a\u00a0b\u2003c\u3000d\x1ce\x85f", "İstanbul ΟΔΟΣ ǅ", "漢字 かな 한글 😀👩‍👩‍👧", "\x00\x01\t\x0b tab\rret", "a" * 3000, "1234 5'6",
    "'s 'S '' ''s", "a\u0327\u0301", "http://x.y/z?a=b&c=%20", "ﬁ ﬃ Å Å",
]


@pytest.mark.parametrize("text", ODD)
def test_ids_of_odd_texts(encoders, text):
    own, library = encoders
    assert np.frombuffer(own(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_ids_of_any_text(encoders, text):
    own, library = encoders
    assert np.frombuffer(own(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_caches_are_bounded_by_bytes(encoders):
    own, library = encoders
    words = [f"{'x' * (i % 1500)}{i}y" for i in range(3000)]
    assert np.frombuffer(own(" ".join(words)), "<u4").tolist() == library.encode(" ".join(words), add_special_tokens=False).ids
    for kept in (own.words, own.pieces):
        assert kept.held == sum(len(k) + len(v) + 160 for k, v in kept.items()) <= 500
        assert sum(len(k) + len(v) + 160 for k, v in kept.older.items()) <= 500


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=8))
def test_ids_of_several_texts(encoders, texts):
    own, library = encoders
    got = [np.frombuffer(ids, "<u4").tolist() for ids in own.many(texts)]
    assert got == [library.encode(text, add_special_tokens=False).ids for text in texts]


def test_a_word_is_looked_up_once_for_many_texts():
    asked = []

    class Asked(dict):
        def __missing__(self, word):
            asked.append(word)
            return word.encode().ljust(4, b"_")

    own = WordEncoder(tokenizer_file("word_bpe_49k.json"))
    own.words = Asked()
    assert own.many(["a b\na", "", "b a"]) == [b"a___b___a___", b"____", b"b___a___"]
    assert sorted(asked) == ["", "a", "b"]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 100), min_size=1, max_size=60))
def test_no_window_overflows(sizes):
    window = spread(sizes, 100)
    assert max(np.bincount(window, weights=sizes)) <= 100


def test_differencing_is_near_equal_and_beats_arrival_order():
    rng = random.Random(3)
    sizes = [rng.randint(1, 256) for _ in range(500)]
    window, most = differencing(sizes, 32)
    loads = np.bincount(window, weights=sizes, minlength=32)
    assert loads.max() == most and loads.max() - loads.min() <= 0.02 * loads.mean()
    assert differencing([8, 7, 6, 5, 4], 2)[1] == 16  # the textbook case
    assert differencing([], 3) == ([], 0)


def test_pieces_cover_documents_and_windows(spark):
    rng = random.Random(4)
    rows = [(i, " ".join("x" for _ in range(rng.choice([0, 1, 5, 40, 90])))) for i in range(200)]
    rows += [(None, "x x"), (7, None), (7, "x x"), (7, "x x"), (500, "x " * 5000)]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, length long").repartition(3)

    def encoder():
        return lambda text: np.arange(len(text.split()), dtype="<u4").tobytes()

    got = pack(docs, encoder, capacity=64, piece=16, ways=8, margin=2).collect()
    assert sum(r["length"] for r in got) == sum(len((t or "").split()) + 1 for _, t in rows)
    assert len({r["doc_id"] for r in got}) == len({i for i, _ in rows})
    loads = {}
    for r in got:
        loads.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert len(r["ids"]) == 4 * r["length"] and r["start"] + r["length"] <= r["doc_tokens"]
    for pieces in loads.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:k]) for k in range(len(pieces))]
        assert sum(n for _, n in pieces) <= 64
    total = sum(r["length"] for r in got)
    assert len(loads) * 64 <= total * 1.12 + 3 * 64
    assert pack(docs.limit(0), encoder).count() == 0
