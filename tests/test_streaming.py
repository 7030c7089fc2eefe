"""The stream's table against the batch job: restarts, killed batches, folding, expiry of state."""

import datetime as dt

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from earshot.operators import trends
from earshot.session import scratch_dir
from earshot.streaming.counts import CountTable, follow, parquet_stream

SCHEMA = "id long, at timestamp, inferred_themes array<string>, theme string"


def messages(day, n):
    at = dt.datetime(2024, 1, 1) + dt.timedelta(days=day)
    lists = [["a"], ["a", "b"], [], None, ["b", "c", "c"], [None]]
    rows = [(day * 100 + i, at + dt.timedelta(hours=i % 24), lists[(day + i) % 6], "own") for i in range(n)]
    return rows + [(day * 100 + 99, None, ["a"], "own")]


@pytest.fixture
def source(spark):
    folder = scratch_dir(spark, "messages")

    def add(day, rows=None):
        data = messages(day, 5 + day % 4) if rows is None else rows
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)

    add.folder = folder
    add(0)
    return add


def start(spark, folder, table, checkpoint, **how):
    stream = parquet_stream(spark, folder, "*.parquet", SCHEMA, files_per_batch=1)
    return follow(stream, table, checkpoint, "at", **how)


def batch(spark, folder):
    return trends.theme_daily_share(spark.read.schema(SCHEMA).parquet(folder), F.to_date("at"))


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("fold_every", [3, 100])
def test_restarts_go_on_where_they_stopped(spark, source, fold_every):
    base = scratch_dir(spark, "counts")
    table = CountTable(spark, f"{base}/table", fold_every)
    assert table.shares().count() == 0
    for day in range(1, 5):
        source(day)
        start(spark, source.folder, table, f"{base}/checkpoint").awaitTermination()
        assert same(table.shares(), batch(spark, source.folder))
    assert len(table._folders("whole")) == (1 if fold_every == 3 else 0)
    batches = len(table._folders("batch"))  # batches that only move the watermark among them
    assert batches >= 5 if fold_every == 100 else batches < 3


@pytest.mark.parametrize(("fold_every", "broken"), [(100, "after"), (100, "before"), (2, "after"), (2, "folded")])
def test_a_killed_batch_changes_nothing(spark, source, fold_every, broken):
    """The sink fails on batch 1 before or after it has written, or after it has folded but before it tidied."""
    base = scratch_dir(spark, "counts")
    table = CountTable(spark, f"{base}/table", fold_every)
    for day in range(1, 4):
        source(day)
    tidy = table._tidy

    def dies(rows, batch_id):
        if batch_id == 1 and broken == "before":
            raise RuntimeError("killed")
        if batch_id == 1 and broken == "folded":
            table._tidy = lambda i: (_ for _ in ()).throw(RuntimeError("killed"))
        table.write(rows, batch_id)
        if batch_id == 1:
            raise RuntimeError("killed")

    with pytest.raises(StreamingQueryException):
        start(spark, source.folder, table, f"{base}/checkpoint", sink=dies).awaitTermination()
    table._tidy = tidy
    start(spark, source.folder, table, f"{base}/checkpoint").awaitTermination()
    assert same(table.shares(), batch(spark, source.folder))
    assert same(trends.emerging_daily(table.shares()), trends.emerging_daily(batch(spark, source.folder)))


def test_state_expires_and_late_messages_are_left_out(spark, source):
    base = scratch_dir(spark, "counts")
    table = CountTable(spark, f"{base}/table")
    held = []
    for day in range(1, 13):
        source(day)
        query = start(spark, source.folder, table, f"{base}/checkpoint", delay="1 day")
        query.awaitTermination()
        held += [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert max(held[-4:]) <= max(held[:6])  # some days' counters, however long the stream has run
    before = batch(spark, source.folder)
    assert same(table.shares(), before)
    source(0, [(7, dt.datetime(2024, 1, 1, 5), ["a"], "late")])  # eleven days late
    start(spark, source.folder, table, f"{base}/checkpoint", delay="1 day").awaitTermination()
    assert same(table.shares(), before)
    source(12, [(8, dt.datetime(2024, 1, 12, 5), ["a"], "in time")])
    start(spark, source.folder, table, f"{base}/checkpoint", delay="1 day").awaitTermination()
    day = table.shares().where("feedback_date = '2024-01-12' AND theme = 'a'").first()
    old = before.where("feedback_date = '2024-01-12' AND theme = 'a'").first()
    assert (day.theme_count, day.total_feedback) == (old.theme_count + 1, old.total_feedback + 1)
