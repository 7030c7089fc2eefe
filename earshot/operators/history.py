"""What a customer had already complained about before each message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.catalogue import NEGATIVE

_EARLIER = (Window.unboundedPreceding, -1)
#: Sampled ids per range of a hot customer-day, and how many cuts are sent to every executor.
SAMPLES, BROADCAST_CUTS = 16, 200_000


def is_negative(sentiment: str = "predicted_sentiment") -> Column:
    return F.coalesce(F.col(sentiment) == NEGATIVE, F.lit(False))


def customer_days(
    feedback: DataFrame,
    customer: str = "customer_id",
    day: str = "feedback_date",
    sentiment: str = "predicted_sentiment",
) -> DataFrame:
    """(customer, day, messages, negatives): one row per customer and day."""
    return (
        feedback.where(F.col(customer).isNotNull())
        .groupBy(customer, day)
        .agg(
            F.count(F.lit(1)).alias("messages"),
            F.sum(is_negative(sentiment).cast("long")).alias("negatives"),
        )
    )


def id_ranges(
    feedback: DataFrame, hot: DataFrame, customer: str, day: str, row_id: str, size: int
) -> DataFrame:
    """(customer, day, _cuts): ids at which a hot customer-day is cut into ranges of about ``size`` messages."""
    chosen = F.pmod(F.xxhash64(F.col(row_id)), F.lit(max(1, size // SAMPLES))) == 0
    sample = feedback.join(hot.select(customer, day), [customer, day], "left_semi").where(chosen)
    place = F.row_number().over(Window.partitionBy(customer, day).orderBy(row_id))
    cuts = sample.select(customer, day, F.col(row_id).alias("_cut"), place.alias("_place"))
    cuts = cuts.where(F.col("_place") % min(SAMPLES, size) == 0).groupBy(customer, day)
    none = F.array().cast(T.ArrayType(feedback.schema[row_id].dataType))
    cuts = hot.select(customer, day).join(cuts.agg(F.collect_list("_cut").alias("_cuts")), [customer, day], "left")
    return cuts.withColumn("_cuts", F.coalesce("_cuts", none))


def prior_complaints(
    feedback: DataFrame,
    customer: str = "customer_id",
    day: str = "feedback_date",
    row_id: str = "feedback_id",
    sentiment: str = "predicted_sentiment",
    customer_columns: DataFrame | None = None,
    hot_day: int = 1_000_000,
    out: str = "repeat_negative_count",
) -> DataFrame:
    """Adds the number of earlier negative messages of the same customer.

    Messages are ordered by (day, id). The fact is never sorted by customer:
    a customer with a third of all messages would fill one task. Instead

    * earlier days come from the (customer, day) counts, whose running sum has
      at most one row per customer and calendar day;
    * only messages of the same day are ranked one by one;
    * a customer-day of more than ``hot_day`` messages is cut into ranges of ids
      that are ranked apart and offset by the totals of the ranges before. The
      ranges follow the order of ids, so the cuts balance the work and change
      no count. They come from a sample of the ids of such days.

    ``customer_columns`` (one row per customer) rides along on the small
    (customer, day) side, so that joining it does not shuffle the fact again.
    Rows without a customer get null; rows without a day count as the latest.
    Finding the hot days takes one job over the keys when this is called.
    """
    undated = F.to_date(F.lit("9999-12-31"))
    feedback = feedback.withColumn("_day", F.coalesce(F.col(day), undated))
    day = "_day"
    days = customer_days(feedback, customer, day, sentiment)
    hot = days.where(F.col("messages") > hot_day).select(customer, day, "messages")
    n_hot, in_hot = hot.agg(F.count(F.lit(1)), F.sum("messages")).first()
    cells = days.select(customer, day, F.lit(0).alias("_part"), "negatives")
    part = F.lit(0)
    if n_hot:
        cuts = id_ranges(feedback, hot, customer, day, row_id, hot_day)
        if n_hot + in_hot // max(hot_day, 1) <= BROADCAST_CUTS:
            cuts = F.broadcast(cuts)
        feedback = feedback.join(cuts, [customer, day], "left")
        part = F.coalesce(F.size(F.filter("_cuts", lambda cut: cut <= F.col(row_id))), F.lit(0))
        hot_cells = (
            feedback.where(F.col("_cuts").isNotNull())
            .groupBy(customer, day, part.alias("_part"))
            .agg(F.sum(is_negative(sentiment).cast("long")).alias("negatives"))
        )
        cells = days.where(F.col("messages") <= hot_day).select(*cells.columns[:2], F.lit(0).alias("_part"), "negatives")
        cells = cells.unionByName(hot_cells)
    running = Window.partitionBy(customer).orderBy(day, "_part").rowsBetween(*_EARLIER)
    cells = cells.select(
        customer, day, "_part", F.coalesce(F.sum("negatives").over(running), F.lit(0)).alias("_before")
    )
    if customer_columns is not None:
        cells = cells.join(customer_columns, customer, "left")
    # rows without a customer match nothing; spread them instead of piling them up
    nobody = F.when(F.col(customer).isNull(), F.pmod(F.xxhash64(F.col(row_id)), F.lit(4096)))
    tagged = feedback.withColumn("_part", F.coalesce(nobody, part).cast("int"))
    same_day = Window.partitionBy(customer, day, "_part").orderBy(row_id).rowsBetween(*_EARLIER)
    earlier_today = F.coalesce(F.sum(is_negative(sentiment).cast("long")).over(same_day), F.lit(0))
    return (
        tagged.join(cells, [customer, day, "_part"], "left")
        .withColumn(out, F.col("_before") + F.when(F.col("_before").isNotNull(), earlier_today))
        .drop("_part", "_cuts", "_before", "_day")
    )
