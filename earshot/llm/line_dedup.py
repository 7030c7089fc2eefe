"""Cross-site boilerplate lines: found by how many sites a line is spread over, and removed.

One aggregation by line hash merges, map-side first, a HyperLogLog sketch of the sites a
line was seen on. Lines whose estimate lies near the threshold are counted exactly, over
their own occurrences only; the others are decided by the estimate. Of a boilerplate
line the first occurrence (smallest document id, then first place) stays, so that no
text is lost to the corpus altogether; all others go.

Only DataFrame operations; the texts themselves are never shuffled for the search, and
for the removal only where the list of documents to change is too large to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import sized_broadcast, stored

#: log2 of the registers of a sketch, and three times its relative standard error.
LOG_REGISTERS, ERROR = 10, 0.1


def line_hash(line: Column) -> Column:
    """Of a line without surrounding blanks; null for a line of blanks."""
    bare = F.trim(line)
    return F.when(bare != "", F.xxhash64(bare))


def lines_of(docs: DataFrame, doc_id: str, text: str, site: str) -> DataFrame:
    """(doc_id, site, place, line): one row per line that is not blank."""
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(site).cast("string").alias("site"),
        F.posexplode(F.transform(F.split(F.col(text), "\n", -1), line_hash)).alias("place", "line"),
    )
    return rows.where(F.col("line").isNotNull())


def boilerplate(docs: DataFrame, sites: int, doc_id: str, text: str, site: str) -> DataFrame:
    """(line, doc_id, place): lines on at least ``sites`` sites, with the occurrence that stays."""
    lines = lines_of(docs, doc_id, text, site)
    spread = lines.groupBy("line").agg(
        F.hll_sketch_agg("site", LOG_REGISTERS).alias("sketch"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "place")).alias("first"),
    )
    estimate = F.hll_sketch_estimate("sketch")
    spread = spread.select("line", "first", estimate.alias("estimate"))
    low, high = int(sites * (1 - ERROR)), int(-(-sites * (1 + ERROR) // 1))
    likely = stored(spread.where(F.col("estimate") >= low), "lines")
    near = likely.where(F.col("estimate") <= high)
    exact = lines.select("line", "site").join(sized_broadcast(near.select("line")), "line", "left_semi")
    exact = exact.groupBy("line", "site").agg(F.lit(1).alias("one")).where(F.col("site").isNotNull())
    enough = exact.groupBy("line").agg(F.count("*").alias("n")).where(F.col("n") >= sites).select("line")
    sure = likely.where(F.col("estimate") > high).select("line", "first")
    found = near.select("line", "first").join(enough, "line", "left_semi").unionByName(sure)
    return found.select("line", "first.doc_id", "first.place")


def dedup_lines(
    docs: DataFrame, sites: int = 8, doc_id: str = "doc_id", text: str = "text", site: str = "source",
    lines_out: str = "n_lines", removed_out: str = "n_removed",
) -> DataFrame:
    """``docs`` with cross-site boilerplate lines removed, plus ``lines_out`` and ``removed_out``.

    A line is a text between line feeds; blanks around it do not count, case does.
    Blank lines are never boilerplate. Null and empty texts are returned as they are; a
    null site is no site; occurrences in one document count once; rows that share an id
    (null included, last in order) keep or lose a line together; all columns of ``docs``
    are kept, whatever their names, and the two counts replace columns of their names.
    """
    found = stored(boilerplate(docs, sites, doc_id, text, site), "boilerplate")
    keep = found.select("line", F.col("doc_id").alias("keep_id"), F.col("place").alias("keep_place"))
    hits = lines_of(docs, doc_id, text, site).join(sized_broadcast(keep), "line")
    stays = F.when(F.col("doc_id").eqNullSafe(F.col("keep_id")), F.col("keep_place")).otherwise(-1)
    hits = hits.select("doc_id", "line", stays.alias("stays"))
    drop = hits.groupBy("doc_id").agg(F.collect_set(F.struct("line", "stays")).alias("drop"))
    drop = stored(drop.withColumnRenamed("doc_id", "drop_id"), "line-drops")
    drop = sized_broadcast(drop, F.sum(F.size("drop")))

    # the caller's columns go by number until the end, so that none can meet a name used here
    own = [f"_in{i}" for i in range(len(docs.columns))]
    at = dict(zip(docs.columns, own, strict=True))
    joined = docs.toDF(*own).join(drop, F.col(at[doc_id]).cast("long").eqNullSafe(F.col("drop_id")), "left")
    lines = F.split(F.col(at[text]), "\n", -1)
    stay = F.filter(
        lines,
        lambda line, i: ~F.exists("drop", lambda d: d["line"].eqNullSafe(line_hash(line)) & (d["stays"] != i)),
    )
    changed = F.col("drop").isNotNull()
    joined = joined.withColumn("stay", F.when(changed, stay))
    cleaned = F.when(changed, F.array_join("stay", "\n")).otherwise(F.col(at[text]))
    return joined.select(
        *[(cleaned if c == text else F.col(at[c])).alias(c) for c in docs.columns if c not in (lines_out, removed_out)],
        F.when(F.col(at[text]).isNull(), 0).otherwise(F.size(lines)).cast("long").alias(lines_out),
        F.when(changed, F.size(lines) - F.size("stay")).otherwise(0).cast("long").alias(removed_out),
    )
