"""Lines that do not fit: set aside with file and reason, or the job fails, whatever the ANSI setting."""

import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from earshot.sources.tables import quarantine, read_csv, read_csv_checked, read_feedback

SCHEMA = T.StructType([
    T.StructField("day", T.DateType()), T.StructField("id", T.LongType()),
    T.StructField("text", T.StringType()), T.StructField("score", T.DoubleType()),
])
GOOD = ["1,x,2024-01-02,\"one, \"\"quoted\"\"\",0.5", "2,,2024-02-29,,", "3,x,,\"\",1e3"]
BAD = {
    "fields": ["4,x,2024-01-01,short", "5,x,2024-01-01,long,1.0,more", "6"],
    "value: day": ["7,x,2024-02-30,t,1.0", "8,x,soon,t,much"],
    "value: id": ["nine,x,2024-01-01,t,1.0"],
    "value: score": ["10,x,2024-01-01,t,1.0.0"],
}


@pytest.fixture
def folder(tmp_path):
    lines = GOOD + [line for group in BAD.values() for line in group]
    for part in (0, 1):
        (tmp_path / f"part{part}.csv").write_text("\n".join(["id,other,day,text,score", *lines[part::2]]) + "\n")
    return str(tmp_path)


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("multi_line", [True, False])
def test_every_line_is_on_one_side(spark, folder, tmp_path, ansi, multi_line):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        good = quarantine(spark, folder, SCHEMA, str(tmp_path / "_aside"), multi_line)
        rows = sorted(good.collect(), key=lambda r: r.id)
        with pytest.raises((PySparkException, Py4JJavaError)):
            read_csv(spark, folder, SCHEMA, multi_line).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert good.schema == SCHEMA
    assert [(r.id, str(r.day), r.score) for r in rows] == [(1, "2024-01-02", 0.5), (2, "2024-02-29", None), (3, "None", 1000.0)]
    assert rows[0].text == 'one, "quoted"'
    found = {}
    for part in (tmp_path / "_aside").glob("*.json"):
        for line in part.read_text().splitlines():
            bad = json.loads(line)
            assert "part" in bad["file"]
            found.setdefault(bad["reason"], []).append(bad["record"].split(",")[0])
    assert {k: sorted(v) for k, v in found.items()} == {
        reason: sorted(line.split(",")[0] for line in lines) for reason, lines in BAD.items()
    }


def test_records_are_kept_as_they_were(spark, folder):
    rows = read_csv_checked(spark, folder, SCHEMA, multi_line=False).bad.collect()
    records = {r.record for r in rows}
    assert set(BAD["fields"]) <= records and "8,x,soon,t,much" in records


def test_a_good_file_loses_nothing(spark, tmp_path):
    (tmp_path / "a.csv").write_text("score,text,id,day\n1.5,\"two\nlines\",1,2024-01-01\n")
    path = str(tmp_path / "a.csv")
    checked = read_csv_checked(spark, path, SCHEMA)
    assert checked.bad.count() == 0
    assert [tuple(r) for r in checked.good.collect()] == [tuple(r) for r in read_csv(spark, path, SCHEMA).collect()]
    with pytest.raises(ValueError):
        read_csv_checked(spark, path, T.StructType.fromDDL("absent string"))


def test_feedback_lists_after_quarantine(spark, tmp_path):
    names = "feedback_id,customer_id,product_id,channel,feedback_date,text,true_themes,true_aspect_sentiments,true_overall_sentiment"
    lines = ["f1,c,p,chat,2024-01-01,\"a\nb\",x|y,x:positive|y:neutral,neutral", "f2,c,p,chat,not a day,t,x,x:positive,positive"]
    (tmp_path / "feedback.csv").write_text("\n".join([names, *lines]) + "\n")
    rows = read_feedback(spark, str(tmp_path / "feedback.csv"), str(tmp_path / "aside")).collect()
    assert len(rows) == 1 and rows[0].true_themes == ["x", "y"] and rows[0].text == "a\nb"
    aside = spark.read.json(str(tmp_path / "aside")).collect()
    assert [r.reason for r in aside] == ["value: feedback_date"]
