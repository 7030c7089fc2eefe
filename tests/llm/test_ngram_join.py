"""Groups of the n-gram join against all pairs by hand."""

import random
import re

import numpy as np
import pytest

from earshot.llm import ngram_join
from earshot.llm.components import components
from earshot.llm.ngram_join import similar_groups


def shingles(text, words):
    got = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(got) < words:
        return {tuple(got)} if got else set()
    return {tuple(got[i: i + words]) for i in range(len(got) - words + 1)}


def plain(rows, words, percent):
    sets = [(i, shingles(t, words)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((top(i), top(j)))
                parent[y] = x
    return sorted(((i, len(s), None if i is None else top(i)) for i, s in sets), key=repr)


def found(spark, rows, words, percent):
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n string").repartition(4)
    return sorted((tuple(r) for r in similar_groups(docs, words, percent).collect()), key=repr)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(500)}"
    return words


def corpus(seed):
    rng = random.Random(seed)
    rows, common = [], [f"c{k}" for k in range(30)]
    for i in range(60):
        base = [f"w{rng.randrange(300)}" for _ in range(rng.choice([3, 5, 8, 12, 20, 40, 80, 200]))]
        if i % 5 == 0:
            base = common + base
        for k in range(rng.choice([1, 1, 2, 4])):
            rows.append((10 * i + k, " ".join(edited(rng, base, k * rng.choice([0, 1, 2])))))
    return rows


@pytest.mark.parametrize("seed, words, percent", [(1, 4, 85), (2, 5, 80), (3, 1, 60)])
def test_equals_all_pairs(spark, seed, words, percent):
    rows = corpus(seed)
    assert found(spark, rows, words, percent) == plain(rows, words, percent)


@pytest.mark.parametrize("boundary", [0, 1000])
def test_boundary_changes_no_group(spark, monkeypatch, boundary):
    monkeypatch.setattr(ngram_join, "light_boundary", lambda table, percent: boundary)
    rows = corpus(4)
    assert found(spark, rows, 4, 85) == plain(rows, 4, 85)


def test_defined_cases(spark):
    long = " ".join(f"v{k}" for k in range(30000))
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, "Two Words"), (5, "two words"), (6, "two"), (7, "a b c d"), (8, "A B\nC  D"),
        (9, long), (10, long + " more"), (None, "a b c d"), (None, None), (7, "two words"), (11, "é É x y"), (12, "é é x y"),
    ]
    assert found(spark, rows, 4, 85) == plain(rows, 4, 85)
    assert similar_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_batches_of_very_few_words():
    for texts in ([], [None], ["a"], ["", "a b"], ["a b c"], ["a", "b", ""], ["a b c d e"]):
        sets, borders = ngram_join.shingle_sets(texts, 4)
        assert list(borders[1:] - borders[:-1]) == [len(shingles(t, 4)) for t in texts] and len(sets) == borders[-1]


def test_chains_of_links_are_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 200)] + [(500, 400), (400, 450)], "a long, b long")
    got = {r["id"]: r["component"] for r in components(links).collect()}
    assert got == {**{i: 1 for i in range(1, 201)}, **{i: 400 for i in (400, 450, 500)}}


def test_bitmaps_never_rule_out_a_near_pair():
    rng = np.random.default_rng(3)
    for n in (1, 5, 120, 130, 1000, 5000):
        base = rng.integers(0, 1 << 63, n).astype(np.uint64)
        for edits in (0, 1, n // 10, n):
            other = np.concatenate([base[edits:], rng.integers(0, 1 << 63, edits // 2 + 1).astype(np.uint64)])
            both = np.concatenate([np.sort(base), np.sort(other)])
            flat, ends, signs = ngram_join.parities(both, np.array([0, len(base), len(both)]))
            one, two = flat[ends[0]: ends[1]].tobytes(), flat[ends[1]: ends[2]].tobytes()
            apart = len(set(base.tolist()) ^ set(other.tolist()))
            least = ngram_join.least_difference(one, two)
            assert least == ngram_join.least_difference(two, one) <= apart
            assert np.bitwise_count((signs[0] ^ signs[1]).view(np.uint64)).sum() <= least
            assert n < 1000 or edits < n or least > 0.3 * apart  # and it does rule out strangers


def test_the_first_turn_meets_members_near_the_middle(spark):
    rows = [(1, d, 100, 100 - e, 7 if d < 50 else d, 7) for d, e in [(1, 9), (2, 0), (3, 5), (4, 7), (50, 3), (51, 1)]]
    index = spark.createDataFrame(rows, "key long, doc_id long, n int, rest int, component long, main long")
    for turn in (0, 2):
        assert sorted(tuple(r) for r in ngram_join.to_main(index, turn, 80).collect()) == [(50, 2), (51, 2)]
