"""Passages found against a plain edit distance over all runs."""

import random

import pytest
from pyspark.sql import functions as F

from earshot.llm.decontamination import Finder, contaminated, matches, words_of


def distance(item, words):
    """Smallest number of word edits between the item and any run of the words."""
    row = [0] * (len(words) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(words, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def damaged(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        kind = rng.randrange(3)
        if kind == 0:
            del words[at]
        else:
            words[at: at + (kind == 1)] = [f"z{rng.randrange(50)}"]
    return words


def corpus(seed, edits):
    rng = random.Random(seed)
    items = [(i, " ".join(f"w{rng.randrange(400)}" for _ in range(rng.choice([6, 14, 25, 40, 70])))) for i in range(30)]
    docs = []
    for i in range(150):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.choice([0, 5, 60, 300]))]
        if i % 2:
            own = items[rng.randrange(30)][1].split()
            own = damaged(rng, own, rng.randint(0, int(edits * len(own))))
            at = rng.randint(0, len(words))
            words[at:at] = own
        docs.append((i, ", ".join(words)))
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_runs(spark, seed):
    docs, items = corpus(seed, 0.2)
    want = {}
    for i, text in docs:
        for j, item in items:
            a, b = words_of(item), words_of(text)
            d = distance(a, b)
            if d <= int(0.2 * len(a) + 1e-9) and b:
                want[i, j] = d
    frame = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, item_id long").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = matches(frame, bench).collect()
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in rows}
    assert len(got) == len(rows) and set(got) <= set(want) and len(got) >= 0.99 * len(want)
    assert all(want[k] == d for k, d in got.items())
    texts, of = dict(docs), dict(items)
    for r in rows:
        run = words_of(texts[r["doc_id"]])[r["first_word"]: r["last_word"] + 1]
        assert distance(run, words_of(of[r["item_id"]])) <= r["distance"]
    flagged = {r["doc_id"] for r in frame.where(contaminated(bench, F.col("text"))).select("doc_id").collect()}
    assert flagged == {i for i, _ in got}


def test_defined_cases(spark):
    bench = spark.createDataFrame(
        [(1, "one two three four five six seven eight nine ten"), (2, None), (3, "!"), (4, "short item"), (5, "short item")],
        "item_id long, text string",
    )
    docs = spark.createDataFrame(
        [(1, None), (2, ""), (3, " \n"), (4, "ONE two-three four; five six seven 8 nine ten"), (5, "a short item here"),
         (6, "short thing item"), (None, "x one two three four five six seven eight nine ten y"), (6, "short thing item"),
         (7, "filler " * 30000 + "one two four five six seven eight nine nine ten"), (8, "one two three ten nine eight")],
        "doc_id long, text string",
    )
    got = sorted((str(r["doc_id"]), r["item_id"], r["distance"], r["first_word"], r["last_word"])
                 for r in matches(docs, bench).collect())
    assert got == [("4", 1, 1, 0, 9), ("5", 4, 0, 1, 2), ("5", 5, 0, 1, 2), ("7", 1, 2, 30000, 30007), ("None", 1, 0, 1, 10)]
    assert matches(docs, bench.limit(0)).count() == 0 and matches(docs.limit(0), bench).count() == 0


def test_repetitions_follow_the_recall():
    items = [(1, " ".join(f"a{i}" for i in range(40)))]
    assert len(Finder(items, 0.2, 0.999, 4).picks) > len(Finder(items, 0.2, 0.9, 4).picks)


def test_every_size_has_its_own_repetitions():
    rng = random.Random(5)
    items = [(i, " ".join(f"w{rng.randrange(90)}" for _ in range(8 if i else 200))) for i in range(60)]
    finder = Finder(items, 0.2, 0.99, 4)
    assert finder.needs[0] != finder.needs[1] and finder.needs.min() > 0
    assert len(finder.tables) == finder.needs.max()
    assert [len(order) for _, order in finder.tables] == [int((finder.needs > s).sum()) for s in range(len(finder.tables))]


@pytest.mark.parametrize("most", [0, 14, 23])
def test_items_beyond_the_repetitions_are_verified_directly(most):
    docs, items = corpus(7, 0.2)
    finder, texts = Finder(items, 0.2, 0.99, 3, most=most), [t for _, t in docs]
    got = {(docs[t][0], finder.ids[i]): d for t, i, d, _, _ in finder.find(texts)}
    want = {}
    for i, text in docs:
        for j, item in items:
            a, b = words_of(item), words_of(text)
            d = distance(a, b)
            if b and d <= int(0.2 * len(a) + 1e-9):
                want[i, j] = d
    assert set(got) <= set(want) and all(want[k] == d for k, d in got.items())
    beyond = {finder.ids[i] for i in range(len(items)) if not finder.needs[i]}
    assert {k for k in want if k[1] in beyond} <= set(got) and len(got) >= 0.98 * len(want)
    assert {len(items[i][1].split()) for i in beyond} == {0: {6, 14, 25, 40, 70}, 14: {25, 40, 70}, 23: {70}}[most]
    assert most or got == want
