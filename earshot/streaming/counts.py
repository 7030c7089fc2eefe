"""Daily theme counts of a feedback stream, kept in a table that the emerging-issue metrics read.

The stream holds one counter per day and theme and one per day for the total. A day's
counters are given up once the watermark has passed it: messages that come later than
``delay`` are not counted. Each micro-batch writes the counters it changed into a folder of
its own, named by its batch id, so that a batch that is run again after a crash replaces
what its first run left behind. Now and then the folders are folded into one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from earshot.operators.trends import shares_of_counts, theme_marks
from earshot.session import scratch_dir

_CELLS = "feedback_date date, is_total boolean, theme string, theme_count long, version long"


def parquet_stream(
    spark: SparkSession, folder: str, pattern: str, schema: T.StructType | str, files_per_batch: int | None = None
) -> DataFrame:
    """New parquet files of a folder as a stream; the schema is given, not guessed."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def count_themes(stream: DataFrame, at: str, theme: str) -> DataFrame:
    """Running (feedback_date, theme, theme_count) of a stream with one theme per message.

    State is one counter per day and theme, however many messages arrive.
    """
    return stream.groupBy(F.to_date(at).alias("feedback_date"), F.col(theme).alias("theme")).agg(
        F.count(F.lit(1)).alias("theme_count")
    )


def daily_theme_counts(stream: DataFrame, at: str, theme: str) -> DataFrame:
    """Reads all that is available and returns the counts, for looking at a bounded stream.

    Complete mode, because append mode would hold back the last open days. The
    result kept in memory is the (day, theme) table, not the messages; it has no totals.
    :func:`follow` is the sink that lasts.
    """
    spark = stream.sparkSession
    name = f"theme_counts_{uuid.uuid4().hex}"
    running = (
        count_themes(stream, at, theme)
        .writeStream.outputMode("complete")
        .format("memory")
        .queryName(name)
        .option("checkpointLocation", scratch_dir(spark, "theme_counts"))
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return spark.table(name)


def running_counts(stream: DataFrame, at: str, themes: str = "inferred_themes", delay: str = "2 days") -> DataFrame:
    """(feedback_date, is_total, theme, theme_count) per day, for list-valued themes.

    Messages without a time count for no day.
    """
    marks = stream.select(F.col(at).cast("timestamp").alias("at"), F.explode(theme_marks(themes)).alias("m"))
    return (
        marks.withWatermark("at", delay)
        .groupBy(F.window("at", "1 day").alias("day"), "m.is_total", "m.theme")
        .agg(F.count(F.lit(1)).alias("theme_count"))
        .select(F.to_date("day.start").alias("feedback_date"), "is_total", "theme", "theme_count")
    )


class CountTable:
    """Versions of the counters below one folder that all executors share.

    ``batch/<id>`` holds the counters a micro-batch changed, ``whole/<id>`` all counters up to that batch.
    The version of a counter is the batch that wrote it, and the last one counts, so it
    does no harm if both are there.
    """

    def __init__(self, spark: SparkSession, path: str, fold_every: int = 100):
        self.spark, self.path, self.fold_every = spark, path.rstrip("/"), fold_every

    def _folders(self, kind: str) -> list[int]:
        """Ids of the complete folders of a kind."""
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(root):
            return []
        found = [status.getPath() for status in files.listStatus(root)]
        done = [p for p in found if files.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(int(p.getName()) for p in done)

    def _drop(self, kind: str, batch_id: int) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}/{batch_id}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def versions(self) -> DataFrame:
        """All written counters; an unfinished folder is not read."""
        parts = [f"{self.path}/{kind}/{i}" for kind in ("whole", "batch") for i in self._folders(kind)]
        if not parts:
            return self.spark.createDataFrame([], _CELLS)
        return self.spark.read.schema(_CELLS).parquet(*parts)

    def current(self) -> DataFrame:
        """(feedback_date, is_total, theme, theme_count, version): the last version of each counter."""
        latest = F.max_by(F.struct("theme_count", "version"), F.col("version")).alias("last")
        merged = self.versions().groupBy("feedback_date", "is_total", "theme").agg(latest)
        return merged.select("feedback_date", "is_total", "theme", "last.theme_count", "last.version")

    def shares(self) -> DataFrame:
        """The table that ``trends.theme_daily_share`` makes of the messages themselves."""
        return shares_of_counts(self.current().drop("version"))

    def write(self, changed: DataFrame, batch_id: int) -> None:
        """The sink of one micro-batch. Running a batch again gives the same table."""
        if batch_id in self._folders("whole"):
            # a second run of a folded batch: the stream's state is only kept if its rows are read
            changed.write.format("noop").mode("overwrite").save()
            self._tidy(batch_id)
            return
        rows = changed.withColumn("version", F.lit(batch_id).cast("long"))
        rows.write.mode("overwrite").parquet(f"{self.path}/batch/{batch_id}")
        if (batch_id + 1) % self.fold_every == 0:
            self.current().write.mode("overwrite").parquet(f"{self.path}/whole/{batch_id}")
            self._tidy(batch_id)

    def _tidy(self, batch_id: int) -> None:
        for i in self._folders("whole"):
            if i < batch_id:
                self._drop("whole", i)
        for i in self._folders("batch"):
            if i <= batch_id:
                self._drop("batch", i)


def follow(
    stream: DataFrame, table: CountTable, checkpoint: str, at: str, themes: str = "inferred_themes",
    delay: str = "2 days", sink: Callable[[DataFrame, int], None] | None = None, **trigger,
) -> StreamingQuery:
    """Starts the stream into the table; ``trigger`` as in ``DataStreamWriter.trigger``, by default all that is there.

    Update mode: a batch hands over the counters it changed. A query that is started
    again with the same checkpoint goes on where the last one stopped.
    """
    return (
        running_counts(stream, at, themes, delay)
        .writeStream.outputMode("update")
        .foreachBatch(sink or table.write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
