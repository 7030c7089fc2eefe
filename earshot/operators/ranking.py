"""Ranks and exact splits over whole tables, without one task holding them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def percentile_of_value(
    weights: DataFrame, value: str, weight: str, slices: int = 128, out: str = "percentile"
) -> DataFrame:
    """(value, percentile): average-tie percentile rank of each distinct value.

    ``weights`` says how many ranked rows carry a value; equal values share the
    mean of their ranks, nulls are not ranked. The distinct values are cut into
    ``slices`` ranges at approximate quantiles and ranked inside their range;
    the rows below a range come from one total per range (at most ``slices`` + 1
    rows, hence the broadcast). The cuts only balance the work: the ranks are
    exact wherever they fall.
    """
    ties = (
        weights.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
        .groupBy(value)
        .agg(F.sum(weight).cast("long").alias("ties"))
    )
    points = [i / slices for i in range(1, slices)]
    cuts = ties.where(F.col("ties") > 0).agg(F.percentile_approx(value, points, 100 * slices)).scalar()
    below_me = F.filter(F.col("_cuts"), lambda cut: cut < F.col(value))
    sliced = ties.withColumn("_cuts", cuts).select(
        value, "ties", F.coalesce(F.size(below_me), F.lit(0)).alias("slice")
    )
    inner = Window.partitionBy("slice")
    ranked = sliced.select(
        value, "ties", "slice",
        F.coalesce(F.sum("ties").over(inner.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("ties").over(inner).alias("inside"),
    )
    # read off the windowed rows, so that both sides share one shuffle by slice
    totals = ranked.groupBy("slice").agg(F.max("inside").alias("inside"))
    by_slice = Window.orderBy("slice")
    offsets = totals.select(
        "slice",
        F.coalesce(F.sum("inside").over(by_slice.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"),
        F.sum("inside").over(by_slice.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("n"),
    )
    mean_rank = F.col("offset") + F.col("before") + (F.col("ties") + 1) / 2
    return ranked.join(F.broadcast(offsets), "slice").select(
        value, (mean_rank.cast("double") / F.col("n").cast("double")).alias(out)
    )


def stratified_split(
    rows: DataFrame,
    label: str,
    row_id: str,
    share: float = 0.2,
    seed: int = 42,
    key: Column | None = None,
    key_bits: int = 64,
    out: str = "is_test",
) -> DataFrame:
    """Marks exactly ``round(share * n)`` rows of every label as test rows.

    Rows are ranked per label by a pseudo-random key, but no label is ever
    sorted as a whole: rows are counted per (label, leading 12 key bits), the
    cell in which the quota runs out is found from those counts, and only that
    cell, about 1/4096 of a label, is ranked. The resulting cut-off per label
    is then compared row by row, so the table itself is not shuffled. The two
    broadcast sides hold one row per class label.
    """
    key = F.xxhash64(F.lit(seed), F.col(row_id)) if key is None else key.cast("long")
    cell = F.shiftright(key, max(key_bits - 12, 0))
    keyed = rows.withColumn("_key", key).withColumn("_cell", cell)
    counts = keyed.groupBy(F.col(label).alias("_label"), "_cell").agg(F.count(F.lit(1)).alias("_n"))
    per_label = Window.partitionBy("_label")
    running = per_label.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    quota = F.floor(F.sum("_n").over(per_label) * F.lit(share) + F.lit(0.5))
    cells = counts.select(
        "_label", "_cell", "_n",
        F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_before"),
        quota.alias("_quota"),
    )
    last = cells.where((F.col("_before") < F.col("_quota")) & (F.col("_before") + F.col("_n") >= F.col("_quota")))
    edge = keyed.select(F.col(label).alias("_label"), "_cell", "_key", F.col(row_id).alias("_id")).join(
        F.broadcast(last.withColumnRenamed("_label", "_edge_label").withColumnRenamed("_cell", "_edge_cell")),
        F.col("_label").eqNullSafe(F.col("_edge_label")) & (F.col("_cell") == F.col("_edge_cell")),
    )
    order = Window.partitionBy("_label", "_cell").orderBy("_key", "_id")
    cut = (
        edge.withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") == F.col("_quota") - F.col("_before"))
        .select(F.col("_label").alias("_cut_label"), F.struct("_key", "_id").alias("_cut"))
    )
    marked = keyed.join(F.broadcast(cut), F.col(label).eqNullSafe(F.col("_cut_label")), "left")
    inside = F.struct("_key", F.col(row_id).alias("_id")) <= F.col("_cut")
    return marked.select(*rows.columns, F.coalesce(inside, F.lit(False)).alias(out))
