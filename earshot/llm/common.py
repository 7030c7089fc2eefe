"""What several operators of this package share: stored intermediates and sized broadcasts."""

from __future__ import annotations

import ctypes
import pickle
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.checks.tables import read
from earshot.session import scratch_dir

# Executors need not have this package installed: helpers travel with their tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a few machine words each that are broadcast without further thought.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read(spark, sf_dir, name)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    Cuts the lineage: what follows restarts from files that outlive executors.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized_broadcast(df: DataFrame, size: Column | None = None, most: int = BROADCAST_ROWS) -> DataFrame:
    """Asks for a broadcast of a stored table if it is measured to be small; else leaves the join to Spark.

    ``size`` aggregates what is counted, the rows if nothing is said: a table with
    list columns should count their elements.
    """
    measured = df.agg(F.count("*") if size is None else size).first()[0] or 0
    return F.broadcast(df) if measured <= most else df


class Shipped:
    """A value of this package's classes, broadcast so that workers without the package can read it."""

    def __init__(self, spark: SparkSession, value: object):
        self._packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def __getstate__(self) -> dict:
        return {"_packed": self._packed}

    @property
    def value(self):
        if "_value" not in self.__dict__:
            self._value = pickle.loads(self._packed.value)
        return self._value


def give_back() -> None:
    """Returns memory that a task no longer uses to the system; Python workers live on for later tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words (the finaliser of splitmix64)."""
    z = values.astype(np.uint64, copy=True)
    z ^= z >> np.uint64(30)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z
