"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

R = TypeVar("R")

#: Settings every job relies on. Partition counts are left to AQE: it starts
#: from ``spark.sql.shuffle.partitions`` and merges or splits from there.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "earshot", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above. Keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder for this run.

    On a cluster it lies under ``spark.checkpoint.dir``, which all executors
    share; without that setting nothing can be shared there, and this fails. On a single
    machine (laptop, tests) it is a local temp folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="earshot-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def spread(df: DataFrame, key: str, split_bytes: int = 16 * 1024 * 1024) -> DataFrame:
    """Spreads an input that is too small to occupy the cores, by its key.

    A parquet file is read by at most one task per row group, so heavy text work
    over a small file would run in one task. The size is Catalyst's estimate of
    the scan, known without a job. Inputs above ``split_bytes`` per core are left
    as they are: at that size the scan has splits enough, and moving text would
    cost more than it gains.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df if size > cores * split_bytes else df.repartition(cores, key)


def without_summary(model):
    """A fitted model without its training summary.

    The summary holds the session, which cannot travel with tasks once the session has observed a
    query (``DataFrame.observe``). Read what is wanted of it before.
    """
    model._java_obj.setSummary(SparkSession.active()._jvm.scala.Option.empty())
    return model


def side_by_side(spark: SparkSession, jobs: Sequence[Callable[[], R]], threads: int = 4) -> list[R]:
    """Runs independent Spark jobs at the same time, so that short ones share the cores."""
    wrap = inheritable_thread_target(spark)
    with ThreadPool(max(1, min(threads, len(jobs)))) as pool:
        return pool.map(lambda job: job(), [wrap(job) for job in jobs])
