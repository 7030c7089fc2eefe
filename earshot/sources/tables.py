"""Readers and writers with explicit schemas."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.catalogue import Phrase
from earshot.functions.text import joined, joined_pairs, split_list, split_pairs

_S, _D, _DATE = T.StringType(), T.DoubleType(), T.DateType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


CUSTOMERS = _schema(
    customer_id=_S, signup_date=_DATE, region=_S, tier=_S, lifetime_value=_D, base_churn_prob=_D
)
PRODUCTS = _schema(product_id=_S, category=_S, price=_D, quality_risk=_S)
ORDERS = _schema(order_id=_S, customer_id=_S, product_id=_S, order_date=_DATE, order_value=_D)
FEEDBACK = _schema(
    feedback_id=_S, customer_id=_S, product_id=_S, channel=_S, feedback_date=_DATE, text=_S,
    true_themes=_S, true_aspect_sentiments=_S, true_overall_sentiment=_S,
)


_FORM = {"header": True, "quote": '"', "escape": '"'}


def _header(spark: SparkSession, path: str, schema: T.StructType, form: dict) -> list[str]:
    names = spark.read.csv(path, **form).columns
    missing = [name for name in schema.names if name not in names]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return names


def _cast(field: T.StructField) -> Column:
    """The value of a text column, null where it does not fit, whatever ``spark.sql.ansi.enabled`` says."""
    return F.col(f"`{field.name}`").try_cast(field.dataType)


def _misfit(field: T.StructField) -> Column:
    return F.col(f"`{field.name}`").isNotNull() & _cast(field).isNull()


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """CSV with a header line; quotes are doubled inside quoted fields.

    Columns are found by their names in the header, in any order; other columns are
    left out, and a missing one is an error. Every file must have the same
    header. A line that does not fit the header or a value that does not fit its
    type fails the job; :func:`read_csv_checked` sets them aside instead. Free text may hold line
    feeds; then a file is read by one task, so large tables come as many files or as parquet.
    ``multi_line=False`` splits files where no field holds a line feed.
    """
    form = {**_FORM, "multiLine": multi_line}
    texts = T.StructType([T.StructField(n, _S, True) for n in _header(spark, path, schema, form)])
    rows = spark.read.schema(texts).csv(path, enforceSchema=False, mode="FAILFAST", **form)

    def checked(field: T.StructField) -> Column:
        said = F.concat(F.lit(f"CAST_INVALID_INPUT: {field.name} is no {field.dataType.simpleString()}: "), F.col(f"`{field.name}`"))
        return F.when(_misfit(field), F.raise_error(said)).otherwise(_cast(field)).alias(field.name)

    return rows.select(*[checked(f) for f in schema.fields])


@dataclass(frozen=True)
class CheckedRows:
    """Rows that fit the schema, and (file, reason, record) of those that do not."""

    good: DataFrame
    bad: DataFrame


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> CheckedRows:
    """CSV as in :func:`read_csv`, but what does not fit is set aside with its file and reason.

    ``fields``: the line has more or fewer fields than the header; the record is the line as it was.
    ``value: <column>``: the first column, in schema order, whose text does not fit its type; the
    record is the line's fields as CSV. Every line ends up on exactly one side.
    """
    form = {**_FORM, "multiLine": multi_line}
    names = _header(spark, path, schema, form)
    texts = T.StructType([T.StructField(n, _S, True) for n in [*names, "_corrupt_record"]])
    # all fields are parsed whatever is selected: a pruned scan would not see that a line is too long
    rows = spark.read.schema(texts).option("columnPruning", False).csv(
        path, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record", **form
    )
    values = F.coalesce(*[F.when(_misfit(f), F.lit(f"value: {f.name}")) for f in schema.fields])
    reason = F.when(F.col("_corrupt_record").isNotNull(), "fields").otherwise(values)
    line = F.to_csv(F.struct(*[F.col(f"`{n}`") for n in names]))
    marked = rows.select(
        *[_cast(f).alias(f.name) for f in schema.fields], F.col("_metadata.file_path").alias("_file"),
        reason.alias("_reason"), F.when(reason.isNotNull(), F.coalesce("_corrupt_record", line)).alias("_record"),
    )
    good = marked.where("_reason IS NULL").select(*schema.names)
    bad = marked.where("_reason IS NOT NULL").select(
        F.col("_file").alias("file"), F.col("_reason").alias("reason"), F.col("_record").alias("record")
    )
    return CheckedRows(good, bad)


def quarantine(spark: SparkSession, path: str, schema: T.StructType, aside: str, multi_line: bool = True) -> DataFrame:
    """The rows that fit; the others are written to the folder ``aside`` as JSON lines."""
    rows = read_csv_checked(spark, path, schema, multi_line)
    write_json(rows.bad, aside)
    return rows.good


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def read_feedback(spark: SparkSession, path: str, aside: str | None = None) -> DataFrame:
    """The base feedback table with its list columns as arrays; bad lines fail, or go to ``aside``."""
    raw = read_csv(spark, path, FEEDBACK) if aside is None else quarantine(spark, path, FEEDBACK, aside)
    return raw.withColumn("true_themes", split_list(F.col("true_themes"))).withColumn(
        "true_aspect_sentiments", split_pairs(F.col("true_aspect_sentiments"))
    )


def flatten_lists(df: DataFrame) -> DataFrame:
    """Array columns as pipe-joined text, for CSV files."""
    out = df
    for field in df.schema.fields:
        if not isinstance(field.dataType, T.ArrayType):
            continue
        element = field.dataType.elementType
        if isinstance(element, T.StructType):
            first, second = element.names
            out = out.withColumn(field.name, joined_pairs(F.col(field.name), first, second))
        else:
            out = out.withColumn(field.name, joined(F.col(field.name)))
    return out


def write_csv(df: DataFrame, path: str) -> None:
    """A table as CSV part files with header lines."""
    flatten_lists(df).write.mode("overwrite").csv(path, header=True, quote='"', escape='"')


def write_json(df: DataFrame, path: str) -> None:
    """A table as JSON lines."""
    df.write.mode("overwrite").json(path, ignoreNullFields=False)


def read_dictionary(spark: SparkSession, path: str) -> dict:
    """A JSON object file. Dictionaries are hand-written, so they fit the driver."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def read_lexicon(spark: SparkSession, path: str) -> list[Phrase]:
    """Lexicon file ``{"phrase": "theme:sentiment"}``; file order is lexicon order."""
    entries = []
    for text, meaning in read_dictionary(spark, path).items():
        theme, sentiment = meaning.split(":")
        entries.append(Phrase(text, theme, sentiment))
    return entries


def lexicon_frame(spark: SparkSession, lexicon: Sequence[Phrase]) -> DataFrame:
    """Lexicon as a table (ord, phrase, theme, sentiment)."""
    rows = [(i, p.text, p.theme, p.sentiment) for i, p in enumerate(lexicon, start=1)]
    return spark.createDataFrame(rows, "ord int, phrase string, theme string, sentiment string")
