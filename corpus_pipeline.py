"""The training-data pipeline: each stage reads what the one before it kept.

A stage is a function (spark, docs, sf_dir) -> DataFrame. All but the last return the
columns of ``documents``; ``run`` writes each result as Parquet into the shared scratch
folder and rereads it as the next stage's input, so a lost executor costs tasks of one
stage only.

Rows with a null text have nothing to judge, change or match: they pass all filters as
clean, and are packed as a document of the end id alone. A null id is carried along.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm import decontamination, line_dedup, ngram_join, quality
from earshot.llm.common import sized_broadcast, stored, table
from earshot.llm.queries import LEAST_QUALITY, packed, quality_model

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def unused(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score under the least quality."""
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    return docs.where(F.col("text").isNull() | (quality.score_of(F.col("text"), model) >= LEAST_QUALITY))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes cross-site boilerplate lines; drops documents of which nothing else is left."""
    n_lines, n_removed = unused(docs, "n_lines"), unused(docs, "n_removed")
    cleaned = line_dedup.dedup_lines(docs, lines_out=n_lines, removed_out=n_removed)
    changed = F.col(n_removed) > 0
    cleaned = cleaned.where(~changed | (F.trim(F.translate("text", "\n\r\t", "   ")) != ""))
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return cleaned.select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group of near duplicates; of fully equal rows, one."""
    groups = stored(ngram_join.similar_groups(docs, words=5, percent=80), "near-groups")
    copies = groups.where("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.join(sized_broadcast(stored(copies, "near-copies")), "doc_id", "left_anti")
    repeated = groups.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1")
    repeated = sized_broadcast(stored(repeated.select("doc_id"), "repeated-ids"))
    once = kept.join(repeated, "doc_id", "left_anti")
    return once.unionByName(kept.join(repeated, "doc_id", "left_semi").distinct()).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark passage."""
    held = decontamination.contaminated(table(spark, sf_dir, "benchmark"), F.col("text"))
    return docs.where(~held)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training windows with their token ids."""
    return packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("keep_quality", keep_quality),
    ("drop_boilerplate", drop_boilerplate),
    ("keep_one_of_each_group", keep_one_of_each_group),
    ("drop_contaminated", drop_contaminated),
    ("pack_windows", pack_windows),
]

#: No SQL: tokenizer files and a trained model take part. tests/llm/test_pipeline.py
#: holds every stage against a plain version on a small table.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``, whole tables and whole texts."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
