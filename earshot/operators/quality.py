"""Data-quality jobs: row counts, reconciliation, orphans, truth leaks, and checks taken while a table is written."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from earshot.functions.numbers import count_where

#: Columns that only evaluation may read.
TRUTH_COLUMNS = frozenset(
    {"true_themes", "true_aspect_sentiments", "true_overall_sentiment", "dominant_true_theme"}
)


def row_counts(tables: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(table_name, expected, actual, ok) for pairs of (source, published) tables."""

    def counted(name: str, source: DataFrame, published: DataFrame) -> DataFrame:
        wanted = source.agg(F.count(F.lit(1))).scalar()
        return published.agg(F.count(F.lit(1)).alias("actual")).select(
            F.lit(name).alias("table_name"), wanted.alias("expected"), "actual"
        )

    parts = [counted(name, *pair) for name, pair in tables.items()]
    return reduce(DataFrame.unionByName, parts).withColumn("ok", F.col("expected") == F.col("actual"))


def orphans(fact: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """(key_name, null_rows, orphan_rows, orphan_keys) per foreign key.

    Rows are counted per key before the join, so a key that holds much of the
    fact reaches the join as one row.
    """

    def one(key: str, dimension: DataFrame) -> DataFrame:
        per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        known = dimension.select(key).distinct().withColumn("_known", F.lit(True))
        joined = per_key.join(known, key, "left")
        lost = F.col(key).isNotNull() & F.col("_known").isNull()
        return joined.agg(
            F.lit(key).alias("key_name"),
            F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("null_rows"),
            F.coalesce(F.sum(F.when(lost, F.col("n"))), F.lit(0)).alias("orphan_rows"),
            F.count_if(lost).alias("orphan_keys"),
        )

    return reduce(DataFrame.unionByName, [one(k, d) for k, d in dimensions.items()])


def columns_read(result: DataFrame) -> set[str]:
    """Names of the columns the scans of a result's physical plan return.

    Taken from the plan after column pruning, scalar subqueries included, so a
    column that is in the table but not needed does not count.
    """
    names: set[str] = set()
    plans = [result._jdf.queryExecution().executedPlan()]
    while plans:
        plan = plans.pop()
        if plan.nodeName() == "AdaptiveSparkPlan":
            plan = plan.initialPlan()
        plans.extend(_items(plan.subqueriesAll()))
        for leaf in _items(plan.collectLeaves()):
            if leaf.nodeName() == "AdaptiveSparkPlan":
                plans.append(leaf)
            else:
                names.update(column.name() for column in _items(leaf.output()))
    return names


def _items(sequence) -> list:
    return [sequence.apply(i) for i in range(sequence.size())]


def assert_no_truth(result: DataFrame, truth: Iterable[str] = TRUTH_COLUMNS) -> None:
    """Fails when an operational result depends on a truth column."""
    leaked = columns_read(result) & set(truth)
    if leaked:
        raise ValueError(f"operational result reads truth columns: {sorted(leaked)}")


# --- checks from the pass that writes a table -------------------------------------


@dataclass(frozen=True)
class Check:
    """Two counts that should agree."""

    name: str
    expected: int
    actual: int

    @property
    def ok(self) -> bool:
        return self.expected == self.actual


def written_with(
    df: DataFrame, write: Callable[[DataFrame], DataFrame], name: str, **counts: Column
) -> tuple[DataFrame, dict[str, int]]:
    """Writes a table and counts it in the same pass: (the stored table, its ``rows`` and the asked ``counts``).

    The counts are taken where the rows are handed to the writer, after the last shuffle, so a task that
    is run again is not counted twice.
    """
    seen = Observation(name)
    total = F.count(F.lit(1)).alias("rows")
    stored = write(df.observe(seen, total, *[c.alias(k) for k, c in counts.items()]))
    return stored, dict(seen.get)


def tier_columns(tiers: Sequence[str] = ("Critical", "High", "Medium", "Low"), column: str = "priority_tier") -> dict[str, Column]:
    """One count for each tier, to be taken by :func:`written_with`."""
    return {tier: count_where(F.col(column) == tier) for tier in tiers}


def fact_checks(source_rows: int, counts: Mapping[str, int], lost: DataFrame) -> list[Check]:
    """Checks of a written fact: no row lost or made, tiers add up, no key without its dimension row.

    ``counts`` are those of the write, ``lost`` is the table of :func:`orphans`.
    """
    tiers = sum(n for name, n in counts.items() if name != "rows")
    found = [Check("rows", source_rows, counts["rows"]), Check("tiers", counts["rows"], tiers)]
    return found + [Check(f"orphans {r['key_name']}", 0, r["orphan_rows"]) for r in lost.orderBy("key_name").collect()]


def check_table(spark: SparkSession, checks: Sequence[Check]) -> DataFrame:
    """(check_name, expected, actual, ok)."""
    rows = [(c.name, c.expected, c.actual, c.ok) for c in checks]
    return spark.createDataFrame(rows, "check_name string, expected long, actual long, ok boolean")


def project_metrics(spark: SparkSession, sizes: Mapping[str, int | None], tiers: Mapping[str, int]) -> DataFrame:
    """One nested row: the size of every table and ``priority_distribution``, a map of rows per tier."""
    names = ", ".join(f"{name} long" for name in sizes)
    return spark.createDataFrame([(*sizes.values(), dict(tiers))], f"{names}, priority_distribution map<string,long>")
