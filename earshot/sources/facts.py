"""Stored tables laid out for the reports: by month for bounded periods, by customer for lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Partition column of tables that are stored by month, ``yyyy-MM``.
MONTH = "feedback_month"


def by_month(df: DataFrame, day: str = "feedback_date") -> DataFrame:
    """The rows dealt out for a write by month.

    Rows of a month go together, but a large month is split and small ones are merged to
    files of useful size. Rows without a day get a partition of their own.
    """
    return df.withColumn(MONTH, F.date_format(day, "yyyy-MM")).hint("rebalance", MONTH)


def write_by_month(df: DataFrame, path: str, day: str = "feedback_date") -> DataFrame:
    """Stores a table in month partitions and reads it back, with the month as its last column."""
    rows = df if MONTH in df.columns else by_month(df, day)
    rows.write.mode("overwrite").partitionBy(MONTH).parquet(path)
    return read_by_month(df.sparkSession, path, rows.schema)


def read_by_month(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def last_day(table: DataFrame, day: str = "feedback_date") -> Column:
    """The newest day as a scalar; of a table stored by month only the newest month is read for it."""
    if MONTH in table.columns:
        table = table.where(F.col(MONTH) == table.agg(F.max(MONTH)).scalar())
    return table.agg(F.max(day)).scalar()


def from_day(table: DataFrame, first: Column, day: str = "feedback_date") -> DataFrame:
    """Rows from ``first`` on. A table stored by month is read from the month of that day on."""
    rows = table.where(F.col(day) >= first)
    return rows.where(F.col(MONTH) >= F.date_format(first, "yyyy-MM")) if MONTH in table.columns else rows


def write_by_key(
    df: DataFrame, path: str, key: str, then: tuple[str, ...] = (), distinct_per_file: int = 100_000,
    row_group_bytes: int = 8 << 20,
) -> DataFrame:
    """Stores a table sorted by ``key`` over all files, for lookups of single keys, and reads it back.

    A lookup skips row groups by their smallest and largest key, and the rest by a Bloom filter.
    Ranges are cut by ``key`` and the columns ``then``, so a key that holds a large part of
    the rows is spread over many files.
    """
    order = [key, *then]
    (
        df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite")
        .option("parquet.block.size", str(row_group_bytes))
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{key}", str(distinct_per_file))
        .parquet(path)
    )
    return df.sparkSession.read.schema(df.schema).parquet(path)
