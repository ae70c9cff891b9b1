"""Order-insensitive comparison of a Spark result with the checking engine's."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

from groundsill.plans.inputs import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    return value


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both hold the same rows, otherwise a short account of what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    order = sorted(names)
    expected = Counter(
        tuple(_plain(v) for v in (row[names.index(c)] for c in order)) for row in result.fetchall()
    )
    actual = Counter(tuple(_plain(row[c]) for c in order) for row in df.collect())
    if actual == expected:
        return None
    extra, missing = list((actual - expected).items()), list((expected - actual).items())
    return (
        f"{sum(actual.values())} rows against {sum(expected.values())};"
        f" {len(extra)} only in Spark, {len(missing)} only in the check; columns {order};"
        f" e.g. {str(sorted(extra, key=str)[:1])[:700]} / {str(sorted(missing, key=str)[:1])[:700]}"
    )
