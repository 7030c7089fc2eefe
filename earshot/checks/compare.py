"""Runs a query in Spark and its SQL in DuckDB and compares rows and values."""

from __future__ import annotations

import datetime as dt
import decimal
import math

from pyspark.sql import DataFrame

from earshot.checks.tables import TABLES


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return int(value) if value.is_integer() else value
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, dt.datetime) and value.time() == dt.time():
        return value.date()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def differences(result: DataFrame, con, sql: str, show: int = 3) -> list[str]:
    """Empty when both sides agree."""
    theirs = con.execute(sql)
    names = [d[0] for d in theirs.description]
    if sorted(names) != sorted(result.columns):
        return [f"columns {sorted(result.columns)} against {sorted(names)}"]
    want = _sorted(names, theirs.fetchall())
    got = _sorted(result.columns, [tuple(r) for r in result.collect()])
    if got == want:
        return [] if got else ["no rows on either side"]
    extra, missing = list(set(got) - set(want))[:show], list(set(want) - set(got))[:show]
    return [f"{len(got)} rows against {len(want)}", *map(str, sorted(names)), f"only spark: {extra}", f"only sql: {missing}"]
