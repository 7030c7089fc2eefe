"""Base spans against the rules written with re; added spans on made-up text."""

import hashlib
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from earshot.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain(text):
    out = []
    for order, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), order, kind, m.end()))
    out.sort()
    return [f"{k}:{a}:{b}" for a, _, k, b in out]


def check(spark, texts):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    rows = {r["doc_id"]: r for r in pii.digest(pii.spans(docs.repartition(3))).collect()}
    assert set(rows) == set(range(len(texts)))
    for i, text in enumerate(texts):
        want, row = plain(text), rows[i]
        assert row["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), (text[:200], want, row)
        assert [row[f"n_{k}"] for k in BASE] == [sum(w.startswith(k) for w in want) for k in BASE]
        assert set(want) <= set(filter(None, row["spans"].split(",")))
    return rows


CASES = [
    "a@b.c", "a@b.c_d@e.f", "x@y", "@a.b", "a@b..c", "a@b.c.", "é78@mail7.example.com", "a@b.c@d.e", "ly.39@mail1.example.com&&&",
    "235.58.234.215", "1.2.3.4.5", "256.1.1.1", "0001.2.3.004", "1.2.3", "1..2.3.4", "9999999999999999999999.1.1.1", "312.1.1.1.2.2.2",
    "4491382641088554", "4491 3826 4108 8554", "4491-3826-4108-8554 5", "4491  3826 4108 8554", "955660381726", "0000 0000 0000", "1",
    "+1 (504) 555-2652", "+1 (504)", "+12345678", "+123456789", "+1..........2345678", "++1 555 555 5555 5555 5555", "+1 (504) 555-2652 +",
    "𝟙𝟚 😀 a@b.c 😀 1.2.3.4", "", " \n ", "1 " * 30000, "1-" * 20000 + "1", "9" * 50000, "a" * 50000 + "@b.c", "a@b" + ".c" * 20000,
    "1.2.3.4 and 4491382641088554, +1 (504) 555-2652; mail a.b+c%d@e-f.g.h", "\x01 1 2 ١٢٣", "4491382641088554 " * 3000,
]


def test_base_spans_equal_the_rules(spark):
    check(spark, [*CASES, None])


def test_parts_of_zero_are_addresses(spark):
    good = ["10.0.0.1", "127.0.0.1", "192.168.0.1", "0.0.0.0", "10.00.1.2", "1.2.3.000", "0" * 4000 + ".1.1.0", "000255.0.0.0255"]
    bad = ["0256.0.0.1", "0.0.0.300", "10.0.0", "0.0.0.1000"]
    rows = check(spark, [*good, *bad])
    assert [rows[i]["n_ip"] for i in range(len(rows))] == [1] * len(good) + [0] * len(bad)


def test_base_spans_on_the_sample_tables(spark):
    for folder in ("sf0.01",):
        rows = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet").collect()
        got = check(spark, [r["text"] for r in rows])
        added = [r["spans"] for i, r in got.items() if r["spans"] != ",".join(plain(rows[i]["text"]))]
        assert len(added) <= 0.02 * len(rows), added[:5]


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab1234567890.@+-() _%é😀\n", max_size=60), min_size=150, max_size=200))
def test_base_spans_of_odd_texts(spark, texts):
    check(spark, texts)


def test_added_spans(spark):
    texts = ["mail to jane.doe [at] example [dot] com now", "call (504) 555-2652 today", "call 504-555-2652 today"] * 20
    texts += ["a@b.com", "call +1 (504) 555-2652", "card 4491 3826 4108 8554"] * 40 + ["nothing here at all"] * 50
    rows = check(spark, texts)
    assert rows[0]["spans"] == "email:8:39"
    assert all(rows[i]["spans"] == "" for i in range(len(texts) - 50, len(texts)))


def test_null_ids_repeats_and_empty_tables(spark):
    schema = "doc_id long, text string"
    docs = spark.createDataFrame([(None, "a@b.c"), (1, "a@b.c"), (1, "a@b.c"), (2, None)], schema)
    got = sorted((str(r["doc_id"]), r["n_email"]) for r in pii.digest(pii.spans(docs)).collect())
    assert got == [("1", 1), ("1", 1), ("2", 0), ("None", 1)]
    assert pii.digest(pii.spans(spark.createDataFrame([], schema))).count() == 0


def test_reliable_labelers_are_recognised():
    prior, chances = pii.reliabilities([("22222", 500), ("00000", 500), ("20222", 30), ("02000", 30), ("22111", 10)])
    assert 0.3 < prior < 0.7
    assert pii.posterior("22222", prior, chances) > 0.99 > 0.01 > pii.posterior("00000", prior, chances)


def test_uses_no_python(spark):
    docs = spark.createDataFrame([(1, "a@b.c")], "doc_id long, text string")
    for df in (pii.candidates(docs, "doc_id", "text"), pii.spans(docs)):
        assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().executedPlan().toString())
