"""Cuts against a walk over the lines, exact round trips and the defined cases."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from earshot.llm.infilling import Lanes, Marks, fill_in_middle, restored, unit_points
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, n string, output string, key string, form string"


def plainly(doc_id, text):
    """The contract, read literally."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, _, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return len(units), "plain", None, None, text
    if h4 % 100 < 50:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@given(st.lists(st.integers(1, 50), max_size=400), st.integers(1, 3), st.integers(1, 9))
@settings(max_examples=60, deadline=None)
def test_lanes_reach_every_rank(widths, bits, top):
    lanes = Lanes(np.array(widths, np.int64), bits, top)
    ends = np.concatenate([[0], np.cumsum(widths)])
    assert [lanes.points_before(rank) for rank in range(len(widths) + 1)] == ends.tolist()


def test_lanes_are_logarithmic():
    lanes = Lanes(np.ones(200_000, np.int64)).lanes
    assert 7 <= len(lanes) <= 11 and len(lanes[-1][0]) <= 32
    for units, points, _ in lanes:
        assert units.sum() == points.sum() == 200_000


@given(st.text(alphabet="ab\n\r é漢😀<P>SM", max_size=60))
@settings(max_examples=200, deadline=None)
def test_units_are_lines(text):
    assert unit_points(text).tolist() == [len(u) for u in re.findall(r"[^\n]*\n|[^\n]+", text)]


TEXTS = [
    None, "", "\n", "\n\n\n", "one line", "a\nb", "a\nb\n", "héé\n漢字\n😀 x\r\n y\n", "has <P> in it\nb", "<M>", "<S", ">\n<", "<\nP>\n",
    "l\n" * 5000 + "end", "x" * 300_000 + "\n" + "é" * 300_000,
]


def test_equals_the_plain_reading_and_comes_back(spark):
    rows = [(i, t, "own n", "o", "k", "f") for i, t in enumerate(TEXTS * 6)]
    rows += [(None, "a\nb\nc", "x", "y", "z", "w")] * 2 + [(7, "twice\nthe id", "", "", "", "")] * 2
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    made = fill_in_middle(docs)
    assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = made.withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    want = sorted([(r[0], *plainly(r[0], r[1]), r[1] or "") for r in rows], key=repr)
    assert sorted([tuple(r) for r in got], key=repr) == want
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_rates_marks_and_empty_tables(spark):
    docs = spark.createDataFrame([(i, f"a{i}\nb\nc") for i in range(400)], "doc_id int, text string")
    forms = dict(fill_in_middle(docs, rate=50, suffix_rate=0).groupBy("form").count().collect())
    assert set(forms) == {"plain", "psm"} and 140 < forms["plain"] < 260
    marks = Marks("[[p]]", "[[s]]", "[[m]]")
    made = fill_in_middle(docs, marks=marks)
    same = made.withColumn("text", restored(F.col("output"), F.col("form"), marks)).select("doc_id", "text")
    assert same.exceptAll(docs).count() == 0 and made.where("output LIKE '[[%'").count() == 400
    assert fill_in_middle(docs.limit(0)).count() == 0
    for broken in (("<P>", "P>x", "<M>"), ("", "s", "m"), ("aa", "ba", "c"), ("ab", "xaby", "q")):
        with pytest.raises(ValueError):
            Marks(*broken)


def test_nothing_is_shuffled(spark):
    docs = spark.createDataFrame([("x", "a\nb")], "doc_id string, text string")
    assert "Exchange" not in fill_in_middle(docs)._jdf.queryExecution().executedPlan().toString()
