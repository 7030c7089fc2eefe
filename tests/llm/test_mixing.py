"""Targets and selections against a plain version, nearness, reruns and the defined cases."""

import hashlib
import math
import re
from fractions import Fraction

import pytest

from earshot.llm.mixing import measured, mix, mixed_texts, mixture, plan
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, source string, target string, _key int, size string"


def plain_targets(totals, weights=(1, 2, 3), most=3):
    """The excess reshared by weight, round after round, in fractions."""
    names = sorted([s for s in totals if s is not None], key=lambda s: s.encode()) + [s for s in totals if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, excess = {s: Fraction(0) for s in names}, set(names), Fraction(sum(totals.values()))
    while excess and free:
        parts = sum(weight[s] for s in free)
        for s in free:
            target[s] += excess * weight[s] / parts
        excess = sum(max(target[s] - most * totals[s], 0) for s in names)
        target = {s: min(t, Fraction(most * totals[s])) for s, t in target.items()}
        free = {s for s in free if target[s] < most * totals[s]}
    return target


def plain_mix(rows):
    def parts(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        return len(words), math.log(len(set(words)) + 1) / math.log(len(words) + 1) if words else 1e-6

    docs, totals = [], {}
    for doc_id, text, source in rows:
        size, quality = parts(text)
        digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        key = -math.log((int(digest[:13], 16) + 0.5) / 2**52) / quality
        docs.append((source, key, doc_id, size))
        totals[source] = totals.get(source, 0) + size
    target, out = plain_targets(totals), []
    for source, total in totals.items():
        aim = float(target[source])
        epochs = int(aim / total) if total else 0
        by_key = {}
        for s, key, _, size in docs:
            if s == source:
                by_key[key] = by_key.get(key, 0) + size
        done, more = 0, set()
        for key, bulk in sorted(by_key.items()):
            done += bulk
            if done - bulk / 2 <= aim - epochs * total:
                more.add(key)
        out += [(i, n, total, aim, n * (epochs + (k in more))) for s, k, i, n in docs if s == source]
    return out


def made(spark, rows, **how):
    df = spark.createDataFrame([(*r, "own", 5, "own") for r in rows], SCHEMA).repartition(3)
    got = mix(df, **how)
    assert got.columns == ["doc_id", "size", "source_size", "target", "copies"]
    return [(r[0], r[1], r[2], r[3], r[1] * r[4]) for r in got.collect()]


def corpus(counts, seed=0):
    rows = []
    for s, (source, n) in enumerate(counts.items()):
        for i in range(n):
            k = (i * 7919 + s * 31 + seed) % 97
            rows.append((1000 * s + i, " ".join(f"w{(i * j) % (k + 1)}" for j in range(k)), source))
    return rows


def near(got, want):
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=repr), sorted(want, key=repr), strict=True):
        assert a[:3] == b[:3] and a[4] == b[4] and a[3] == pytest.approx(b[3], rel=1e-12)


@pytest.mark.parametrize("counts", [
    {"a": 200, "b": 50, "c": 10, "é": 5, None: 30},
    {"z": 400, "y": 3, "x": 3, "w": 3, "v": 1, "u": 1, "t": 0},
    {"only": 60},
    {f"s{i}": 1 + i * i for i in range(13)},
])
def test_equals_the_plain_version(spark, counts):
    rows = corpus(counts)
    near(made(spark, rows), plain_mix(rows))


def test_targets_are_met_and_bounded(spark):
    rows = corpus({"big": 3000, "mid": 500, "low": 40})
    got = made(spark, rows)
    sums = {}
    for _, size, total, target, taken in got:
        assert taken <= 3 * size and (not size or taken % size == 0)
        sums[target] = sums.get(target, 0) + taken
    assert all(abs(taken - target) <= 97 for target, taken in sums.items())
    assert sum(sums) == pytest.approx(sum(r[1] for r in got))
    assert sorted(got) == sorted(made(spark, list(reversed(rows))))  # neither order nor partitions matter


def test_better_documents_are_likelier(spark):
    rows = [(i, "word " * 20 if i % 2 else " ".join(f"w{j}" for j in range(20)), "s") for i in range(2000)]
    got = made(spark, rows, share=0.3)
    taken = [sum(t > 0 for i, *_, t in got if i % 2 == odd) for odd in (0, 1)]
    assert taken[0] > 2 * taken[1] > 0
    even = mix(
        spark.createDataFrame([(*r, "", 0, "") for r in rows], SCHEMA), share=0.3, quality=F.lit(1.0)
    ).where("copies > 0").groupBy((F.col("doc_id") % 2).alias("odd")).count().collect()
    assert max(r[1] for r in even) < 1.3 * min(r[1] for r in even)


def test_nulls_empties_repeats_and_long_texts(spark):
    rows = [(None, None, None), (None, "", "a"), (1, " \t\n", "a"), (2, "a b", "a"), (2, "a b", "a"), (2, "a b", "a"), (None, "q r s", None),
            (3, "x " * 400_000, "b"), (4, "one", "c")]
    near(made(spark, rows), plain_mix(rows))
    assert made(spark, [(1, None, "a"), (2, " ", None)]) in (
        [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)], [(2, 0, 0, 0.0, 0), (1, 0, 0, 0.0, 0)])
    assert made(spark, []) == []
    df = spark.createDataFrame([(i, "a b c", "s") for i in range(50)], "doc_id long, text string, source string")
    for bad in (F.lit(None), F.lit(float("nan")), F.lit(-1.0)):
        assert mix(df, quality=bad, share=0.5).agg(F.sum("copies")).first()[0] == 25


def test_mixed_texts_are_the_rows_as_often_as_taken(spark):
    rows = corpus({"big": 300, "low": 20})
    df = spark.createDataFrame([(*r, "own", 5, "own") for r in rows], SCHEMA)
    texts, counts = mixed_texts(df), mix(df).where("copies > 0")
    assert texts.columns == df.columns
    want = {r["doc_id"]: r["copies"] for r in counts.collect()}
    assert {r["doc_id"]: r["count"] for r in texts.groupBy("doc_id").count().collect()} == want
    assert texts.distinct().exceptAll(df).count() == 0


def test_no_python_in_the_plans(spark):
    df = spark.createDataFrame([(1, "a b", "s")], "doc_id long, text string, source string")
    found = mixture(df)
    for part in (measured(df), plan(found.documents, (1, 2, 3), 1.0, 3), mix(df), mixed_texts(df)):
        shown = part._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in shown and "Arrow" not in shown and "CartesianProduct" not in shown
    with pytest.raises(ValueError):
        mix(df, weights=())
    with pytest.raises(ValueError):
        mix(df, share=4.0)
