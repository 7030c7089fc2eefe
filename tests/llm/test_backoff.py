"""Stupid-backoff scores against a plain dictionary version."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from earshot.llm.backoff import BITS, Ranks, common_words, narrow, ngram_scores, widened
from earshot.llm.queries import QUERIES


def micro(x):
    return int(math.floor(math.log(x) * 1e6 + 0.5))


def plain(rows, order=3, discount=0.4):
    texts = [(i, re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))) for i, t in rows]

    def counts_of(words):
        grams, contexts = Counter(), Counter()
        for n in range(1, order + 1):
            full = [None] * (n - 1) + words
            for j in range(len(words)):
                grams[tuple(full[j: j + n])] += 1
                if n == 1:
                    contexts[()] += 1
                else:
                    contexts[tuple(full[j: j + n - 1])] += 1
            if n > 1 and words:
                contexts[tuple(full[-(n - 1):])] += 1  # before the end of the text
        return grams, contexts

    grams, contexts, own = Counter(), Counter(), []
    for _, words in texts:
        own.append(counts_of(words))
        grams.update(own[-1][0])
        contexts.update(own[-1][1])
    out = defaultdict(lambda: [0, 0, 0])
    for (i, words), (own_grams, own_contexts) in zip(texts, own, strict=True):
        out[i][0] += len(words)
        for j in range(len(words)):
            for n in range(order, 0, -1):
                gram = tuple(([None] * (n - 1) + words)[j: j + n])
                c = grams[gram] - own_grams[gram]
                if c:
                    total = contexts[gram[:-1]] - own_contexts[gram[:-1]]
                    out[i][2] += micro(c) - micro(total) + (order - n) * micro(discount)
                    out[i][1] += n < order
                    break
            else:
                out[i][2] += order * micro(discount) - micro(max(contexts[()] - len(words), 1))
                out[i][1] += 1
    return dict(out)


ROWS = [
    (1, "the cat sat on the mat the cat sat"), (2, "the dog sat on the cat"), (3, "The\tCAT\nsat É é"),
    (4, ""), (5, None), (6, "  \n "), (7, "lonely"), (8, "the cat sat on the mat the cat sat"),
    (9, "x " * 5000), (None, "the cat"), (8, "the dog"), (None, "the cat sat"), (10, "x x x y"),
]


@pytest.mark.parametrize("order, shipped, chunk, bucket", [
    (3, 65_536, 6 << 20, 6 << 20), (3, 4, 1, 90), (3, 0, 100, 500), (1, 3, 100, 1000), (2, 5, 200, 3000), (4, 6, 300, 700), (5, 100, 90, 90),
])
def test_equals_plain_counts(spark, order, shipped, chunk, bucket):
    docs = spark.createDataFrame(
        [(i, t, 0, 0) for i, t in ROWS], "doc_id long, text string, chunk long, block long"
    ).repartition(3)
    rows = ngram_scores(docs, order, shipped=shipped, chunk_chars=chunk, bucket_bytes=bucket).collect()
    assert {r["doc_id"]: [r["n_words"], r["n_backed_off"], r["log_score_micro"]] for r in rows} == plain(ROWS, order)
    assert all((r["mean_log_score"] is None) == (r["n_words"] == 0) for r in rows) and len(rows) == 11
    assert ngram_scores(docs.limit(0), order).count() == 0


def test_one_text_alone_backs_off_to_the_end(spark):
    docs = spark.createDataFrame([(1, "a b a b")], "doc_id long, text string")
    row = ngram_scores(docs).first()
    assert (row["n_words"], row["n_backed_off"], row["log_score_micro"]) == (4, 4, 12 * micro(0.4))


def test_unheard_of_text_scores_below_prose(spark):
    rows = [(i, "the cat sat on the mat and the dog sat on the cat") for i in range(5)]
    rows.append((9, " ".join(f"invented{i}" for i in range(15))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    mean = {r["doc_id"]: r["mean_log_score"] for r in ngram_scores(docs).collect()}
    assert mean[9] < min(mean[i] for i in range(5)) - 3


def test_the_query_keeps_rare_words_and_all_orders(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r["doc_id"]: [r["n_words"], r["n_backed_off"], r["log_score_micro"]] for r in QUERIES["op9_lm_scores"](spark, sf_dir).collect()}
    assert got == plain(rows)
    backed = sum(b for _, b, _ in got.values())
    assert 0 < backed < sum(n for n, _, _ in got.values())


def test_blocks_come_back_as_they_were():
    rng = np.random.default_rng(3)
    for top in (1, 200, 70_000, 2**40, 2**64 - 1):
        values = rng.integers(0, top, 50, dtype=np.uint64, endpoint=True)
        assert (widened(narrow(values)) == values).all()
    ranks = Ranks(rng.permutation(1000).astype(np.uint64), np.arange(1000, 0, -1))
    assert (np.sort(ranks.of(np.arange(1000, dtype=np.uint64))) == np.arange(2, 1002)).all()
    some = rng.integers(1, 1002, (3, 5000)).astype(np.uint64)
    shift = np.uint64(BITS)
    pairs = (some[0] << shift) + some[1]
    hashes = rng.integers(2**63, 2**64 - 1, 5000, dtype=np.uint64)
    keys = np.unique(np.concatenate([some[0], pairs, (pairs << shift) + some[2], hashes]))
    for buckets in (1, 3, 977):
        kind, place = ranks.ranges(keys, buckets)
        assert set(kind) == {1, 2, 3, 4} and place.min() >= 0 and place.max() < buckets
        assert (np.diff(kind * buckets + place) >= 0).all()


def test_two_shuffles_carry_the_counts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = ngram_scores(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3 and "Join" not in plan  # the third adds up a document's rows


def test_common_words_are_bounded(spark):
    docs = spark.createDataFrame([(i, "a " * 9 + "b " * 5 + "c c d d " + f"e{i}") for i in range(4)], "doc_id long, text string")
    assert [len(common_words(docs, most)[0]) for most in (0, 1, 2, 3, 100)] == [0, 1, 2, 3, 4]  # of equals in a task, the smaller number
    assert common_words(docs, 100)[1].tolist() == [36, 20, 8, 8]
    assert len(common_words(docs.limit(0), 5)[0]) == 0
