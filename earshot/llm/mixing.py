"""A mix of sources to target weights, by Efraimidis-Spirakis sampling. DataFrame functions only.

Sources in code point order (null last) weigh 1, 2, 3, repeating, and share the words of
all documents by weight; no target passes ``most`` times its source's words, and what a
source cannot take is shared anew among the others. A target is met by whole epochs of
the source first. What is left takes documents in the order of their keys -ln(u) / q, u
a number drawn from the id and q the document's quality weight, up to the key at which the
words taken are nearest to the target.

No source is sorted whole. Keys fall into buckets of their logarithm; bucket totals say
in which bucket a source's budget ends, and only that one (about 1 in 2,800 of a source's
documents, whatever the quality weights) is ordered by key.

Defined cases: a null text holds no words; a document without words is taken with 0. A
null source is a source of its own. Rows of one source with equal ids and texts share a
key and are taken or left together; a null id is drawn as an empty one. Quality weights that are null, NaN or not
positive count as the least one. An empty table gives no rows. Texts are read whole. Of the
extra columns of ``docs`` :func:`mix` returns none and :func:`mixed_texts` all, unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.functions.text import bind
from earshot.llm.common import sized_broadcast, stored

#: Runs of anything but the blank and the controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]++"
LEAST_QUALITY = 1e-6
#: Buckets per unit of a key's natural logarithm.
FINENESS = 1024


def text_measures(text: Column) -> Column:
    """(size, quality) of a text: its words, and Herdan's ratio of distinct to all words, 0 to 1."""

    def measures(words: Column) -> Column:
        size = F.size(words).cast("long")
        distinct = F.size(F.array_distinct(words)).cast("double")
        ratio = F.log(distinct + 1) / F.log(size.cast("double") + 1)
        return F.struct(size.alias("size"), F.when(size > 0, ratio).otherwise(0.0).alias("quality"))

    return bind(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0)), measures)


def draw(key: Column, seed: int) -> Column:
    """A number between 0 and 1, both excluded, that depends on the seed and the id alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(2**52))


def measured(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    quality: Column | None = None, seed: int = 7, keep: Sequence[Column] = (),
) -> DataFrame:
    """(_id, _source, _size, _key, _bucket) of every document, besides the columns to keep."""
    found = docs.select(
        *keep, F.col(key).alias("_id"), F.col(source).alias("_source"), text_measures(F.col(text)).alias("_m"),
        (F.lit(None).cast("double") if quality is None else quality.cast("double")).alias("_q"),
    )
    asked = F.col("_m.quality") if quality is None else F.col("_q")
    weight = F.when((asked > LEAST_QUALITY) & ~F.isnan(asked), asked).otherwise(F.lit(LEAST_QUALITY))
    kept = [c for c in found.columns if c not in ("_m", "_q")]
    keyed = found.select(*kept, F.col("_m.size").alias("_size"), (-F.log(draw(F.col("_id"), seed)) / weight).alias("_key"))
    return keyed.withColumn("_bucket", F.floor(F.log("_key") * FINENESS))


def ranked(sources: DataFrame, name: str) -> DataFrame:
    """Adds ``_rank`` (from 0) by code point, null last, without bringing all sources to one task."""
    order = F.col(name).asc_nulls_last()
    # stored, as the borders of the ranges are sampled anew with every run of the plan
    ranges = sources.repartitionByRange(order).withColumn("_range", F.spark_partition_id())
    ranges = stored(ranges, "source-ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.groupBy("_range").agg(F.count("*").alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    place = F.row_number().over(Window.partitionBy("_range").orderBy(order)) - 1
    return ranges.withColumn("_place", place).join(F.broadcast(offsets), "_range").withColumn(
        "_rank", F.col("_before") + F.col("_place")
    ).drop("_range", "_place", "_before")


def targets(sources: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """Adds ``_target`` to (_source, _total): shares by weight, held at ``most`` times the total.

    The level, words per unit of weight, rises as held sources leave their excess to the others;
    each round is one aggregate over the sources, two whole numbers of which reach the driver.
    """
    cycle = F.array(*[F.lit(int(w)).cast("long") for w in weights])
    weight = F.get(cycle, (F.col("_rank") % len(weights)).cast("int"))
    rows = ranked(sources, "_source").select(
        "_source", "_total", weight.alias("_w"), (F.col("_total") * most).alias("_cap")
    )
    rows = stored(rows, "source-weights")

    def held(words: int, parts: int) -> Column:
        wide = "decimal(38,0)"
        return F.col("_cap").cast(wide) * F.lit(parts).cast(wide) <= F.lit(words).cast(wide) * F.col("_w").cast(wide)

    total, parts = rows.agg(F.sum("_total"), F.sum("_w")).first()
    wanted = int((total or 0) * share)
    words, n_held = wanted, 0
    while parts:
        test = held(words, parts)
        n, caps, left = rows.agg(
            F.count_if(test), F.coalesce(F.sum(F.when(test, F.col("_cap"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~test, F.col("_w"))), F.lit(0)),
        ).first()
        if n == n_held or not left:
            break
        words, parts, n_held = max(wanted - caps, 0), left, n
    level = F.lit(words / parts if parts else 0.0)
    capped = held(words, parts) if parts else F.lit(True)
    return rows.select(
        "_source", "_total",
        F.when(capped, F.col("_cap").cast("double")).otherwise(level * F.col("_w")).alias("_target"),
    )


@dataclass(frozen=True)
class Mixture:
    """Documents with their sizes and keys, and one row for each source that says what it gives."""

    documents: DataFrame
    sources: DataFrame


def plan(rows: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """(_source, _total, _target, _epochs, _cut_bucket, _cut_key) of measured documents.

    A document is taken ``_epochs`` times, and once more if it lies in a bucket before the
    cut, or in that bucket and not beyond the cut key.
    """
    by_bucket = stored(rows.groupBy("_source", "_bucket").agg(F.sum("_size").alias("_bulk")), "bucket-sizes")
    totals = by_bucket.groupBy("_source").agg(F.sum("_bulk").alias("_total"))
    aims = targets(totals, weights, share, most)
    epochs = F.when(F.col("_total") > 0, F.floor(F.col("_target") / F.col("_total"))).otherwise(0)
    aims = aims.withColumn("_epochs", epochs.cast("long"))
    aims = stored(aims.withColumn("_left", F.col("_target") - F.col("_epochs") * F.col("_total")), "source-targets")

    # the last bucket that begins within the budget
    budgets = sized_broadcast(aims.select(F.col("_source").alias("_of"), "_left"))
    upto = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    begun = by_bucket.withColumn("_begin", F.coalesce(F.sum("_bulk").over(upto), F.lit(0)))
    begun = begun.join(budgets, F.col("_source").eqNullSafe(F.col("_of"))).where(F.col("_begin") < F.col("_left"))
    cut = begun.groupBy("_of").agg(F.max(F.struct("_bucket", "_begin")).alias("_cut"))
    cut = stored(cut.select("_of", F.col("_cut._bucket").alias("_cut_bucket"), F.col("_cut._begin").alias("_begin")), "cuts")
    aims = aims.join(sized_broadcast(cut), F.col("_source").eqNullSafe(F.col("_of")), "left").drop("_of")
    aims = stored(aims, "aims")

    # inside that bucket: keys in order, up to the one that ends nearest to the budget
    ends = sized_broadcast(aims.where("_cut_bucket IS NOT NULL").select(
        F.col("_source").alias("_of"), "_cut_bucket", "_begin", "_left"
    ))
    inside = rows.join(ends, F.col("_source").eqNullSafe(F.col("_of")) & (F.col("_bucket") == F.col("_cut_bucket")))
    inside = inside.groupBy("_of", "_begin", "_left", "_key").agg(F.sum("_size").alias("_bulk"))
    running = F.sum("_bulk").over(Window.partitionBy("_of").orderBy("_key").rowsBetween(Window.unboundedPreceding, 0))
    middle = F.col("_begin") + running - F.col("_bulk") / 2
    taken = inside.withColumn("_middle", middle).where(F.col("_middle") <= F.col("_left"))
    keys = stored(taken.groupBy("_of").agg(F.max("_key").alias("_cut_key")), "cut-keys")
    return aims.join(sized_broadcast(keys), F.col("_source").eqNullSafe(F.col("_of")), "left").select(
        "_source", "_total", "_target", "_epochs", "_cut_bucket", "_cut_key"
    )


def with_copies(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Adds _total, _target and _copies, the times a document enters the mix, to measured documents."""
    ends = sized_broadcast(sources.withColumnRenamed("_source", "_of"))
    once_more = (F.col("_bucket") < F.col("_cut_bucket")) | (
        (F.col("_bucket") == F.col("_cut_bucket")) & F.coalesce(F.col("_key") <= F.col("_cut_key"), F.lit(False))
    )
    copies = F.col("_epochs") + F.coalesce(once_more, F.lit(False)).cast("long")
    joined = rows.join(ends, F.col("_source").eqNullSafe(F.col("_of")), "left")
    return joined.withColumn("_copies", F.when(F.col("_size") > 0, copies).otherwise(F.lit(0).cast("long")))


def mixture(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[int] = (1, 2, 3), share: float = 1.0, most: int = 3,
    quality: Column | None = None, seed: int = 7,
) -> Mixture:
    """What every source gives. ``share`` is the mix's size in parts of all words.

    ``quality`` weighs documents within their source; by default Herdan's ratio of distinct words.
    """
    if not weights or any(int(w) != w or w < 1 for w in weights):
        raise ValueError("weights are whole numbers from 1")
    if not 0 <= share <= most:
        raise ValueError("the share lies between none and `most` times all words")
    rows = stored(measured(docs, key, text, source, quality, seed), "mix-keys")
    return Mixture(rows, stored(plan(rows, weights, share, most), "mix-sources"))


def mix(docs: DataFrame, key: str = "doc_id", **how) -> DataFrame:
    """(key, size, source_size, target, copies) of every document; see :func:`mixture`."""
    found = mixture(docs, key, **how)
    return with_copies(found.documents, found.sources).select(
        F.col("_id").alias(key), F.col("_size").alias("size"), F.col("_total").alias("source_size"),
        F.col("_target").alias("target"), F.col("_copies").alias("copies"),
    )


def mixed_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 7,
                quality: Column | None = None, **how) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it was taken.

    Texts are not shuffled unless there are more sources than a broadcast may hold.
    """
    found = mixture(docs, key, text, source, quality=quality, seed=seed, **how)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = with_copies(measured(docs, key, text, source, quality, seed, keep=[whole]), found.sources)
    again = rows.where("_copies > 0").select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    return again.select("_row.*")
