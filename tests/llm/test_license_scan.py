"""Notices found against a plain containment over all windows."""

import random

import pytest

from earshot.llm import license_scan
from earshot.llm.license_scan import NOTICES, bands_needed, notice_words, scan, shingles, step_of, telling_words


def plain(rows, notices, share=0.8):
    out = {}
    for i, text in rows:
        words = notice_words(text or "")
        for name, notice in notices.items():
            n = len(notice_words(notice))
            want = set(shingles(notice_words(notice)))
            for start in range(0, max(len(words) - n, 0) + 1, step_of(n)):
                held = len(want & set(shingles(words[start: start + n + step_of(n)]))) / len(want)
                if held >= share and (held, -start) > out.get((i, name), (0, 0)):
                    out[i, name] = (held, -start)
    return {k: (held, -start) for k, (held, start) in out.items()}


def found(spark, rows, notices=None):
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, license_id string")
    got = scan(docs, notices).collect()
    out = {(r["doc_id"], r["license_id"]): (r["containment"], r["first_word"]) for r in got}
    assert len(out) == len(got)
    return out


def test_every_shingle_has_a_telling_word():
    marks = set(telling_words(NOTICES))
    assert all(marks & set(s.split()) for t in NOTICES.values() for s in shingles(notice_words(t)))


def test_bands_reach_the_certainty():
    for size in (5, 7, 10, 20, 40):
        of_notice, of_window = size - 4, size + step_of(size) - 4
        common = -(-8 * of_notice // 10)
        alike = common / (of_notice + of_window - common)
        assert 1 - (1 - alike) ** bands_needed(size, 0.8, 0.9999) >= 0.9999


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_windows(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(60):
        words = [f"w{rng.randrange(50)}" for _ in range(rng.choice([0, 3, 30, 120]))]
        for _ in range(rng.randrange(3)):
            notice = NOTICES[rng.choice(sorted(NOTICES))].split()
            if rng.random() < 0.4:
                notice[rng.randrange(len(notice))] = "other"
            at = rng.randint(0, len(words))
            words[at:at] = notice
        rows.append((i, " ".join(words).upper() if i % 3 else ",\n".join(words)))
    assert found(spark, rows) == plain(rows, NOTICES)


def test_defined_cases(spark):
    notice = NOTICES["mit"]
    rows = [
        (1, None), (2, ""), (3, "License"), (4, notice), (4, notice + "!"), (None, "x " + notice), (5, "a " * 30000 + notice),
        (6, "é released under the mit license é"), (7, "released under the license"),
    ]
    assert found(spark, rows) == plain(rows, NOTICES)
    assert found(spark, []) == {}
    with pytest.raises(ValueError):
        found(spark, rows, {"short": "two words"})


def test_uses_no_python(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert "Python" not in scan(docs)._jdf.queryExecution().executedPlan().toString()


def test_chunks_change_no_match(spark, monkeypatch):
    words = [f"w{i % 97}" for i in range(900)]
    for at in (0, 60, 61, 64, 130, 333, 620, 880):
        words[at:at] = license_scan.NOTICES["mit-grant" if at % 2 else "apache-2.0"].split()
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[5:400])), (3, "too short"), (4, license_scan.NOTICES["mit"])], "doc_id long, text string")
    whole = sorted(map(tuple, license_scan.scan(docs).collect()))
    assert whole
    for chunk in (7, 64, 100):
        monkeypatch.setattr(license_scan, "CHUNK", chunk)
        assert sorted(map(tuple, license_scan.scan(docs).collect())) == whole


def test_a_very_long_text(spark):
    text = "filler words of no meaning " * 450_000 + license_scan.NOTICES["apache-2.0"]  # 12 MB
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [r.license_id for r in license_scan.scan(docs).collect()] == ["apache-2.0"]
