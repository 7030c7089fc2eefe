"""Stupid-backoff scores against a plain dictionary version."""

import math
import re
from collections import Counter, defaultdict

import pytest

from earshot.llm.lm_scores import lm_scores


def micro(x):
    return int(math.floor(math.log(x) * 1e6 + 0.5))


def plain(rows, vocabulary, least=2, discount=0.4):
    texts = [(i, re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))) for i, t in rows]
    words = Counter(w for _, t in texts for w in t)
    top = [n for _, n in words.most_common()]
    assert vocabulary >= len(top) or top[vocabulary - 1] > top[vocabulary], "a tie would hang on the word number"
    known = {w for w, _ in words.most_common(vocabulary)}
    as_known = [(i, ["<s>", *(w if w in known else "<u>" for w in t)]) for i, t in texts]
    single = Counter(w for _, t in as_known for w in t)
    single["<s>"] = sum(len(t) > 1 for _, t in as_known)
    pairs = Counter(p for _, t in as_known for p in zip(t, t[1:], strict=False))
    total, out = sum(words.values()), defaultdict(lambda: [0, 0])
    for i, t in as_known:
        out[i][0] += len(t) - 1
        for v, w in zip(t, t[1:], strict=False):
            if pairs[v, w] >= least:
                out[i][1] += micro(pairs[v, w]) - micro(single[v])
            else:
                out[i][1] += micro(single[w]) + round(math.log(discount) * 1e6) - round(math.log(total) * 1e6)
    return dict(out)


ROWS = [
    (1, "the cat sat on the mat the cat sat"), (2, "the dog sat on the cat"), (3, "The\tCAT\nsat É é"),
    (4, ""), (5, None), (6, "  \n "), (7, "lonely"), (8, "the cat sat on the mat the cat sat"),
    (9, "x " * 5000), (None, "the cat"), (8, "the dog"),
]


@pytest.mark.parametrize("vocabulary", [1000, 1])
def test_equals_plain_counts(spark, vocabulary):
    docs = spark.createDataFrame([(i, t, 0) for i, t in ROWS], "doc_id long, text string, n long").repartition(3)
    got = {r["doc_id"]: [r["n_words"], r["log_score_micro"]] for r in lm_scores(docs, vocabulary).collect()}
    assert got == plain(ROWS, vocabulary)


def test_blank_texts_have_no_mean_and_empty_tables_no_rows(spark):
    docs = spark.createDataFrame([(4, ""), (5, "a b")], "doc_id long, text string")
    got = {r["doc_id"]: r["mean_log_score"] for r in lm_scores(docs).collect()}
    assert got[4] is None and got[5] < 0
    assert lm_scores(docs.limit(0)).count() == 0


def test_follows_the_sample_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["doc_id"]: [r["n_words"], r["log_score_micro"]] for r in lm_scores(docs, 65_536).collect()}
    assert got == plain(rows, 65_536)
