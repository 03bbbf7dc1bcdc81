"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime
import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{Path(folder) / name}.parquet'")
    return con


def plain(value):
    """A hashable value that is equal for equal results of both engines."""
    if value is None:
        return None
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return int(value) if value == int(value) else round(value, 9)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(spark_df, con, sql: str) -> str | None:
    """None when both results hold the same rows, a description otherwise."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(names)}"
    expected = bag(names, result.fetchall())
    actual = bag(spark_df.columns, spark_df.collect())
    if actual == expected:
        return None
    extra, lacking = actual - expected, expected - actual
    return (
        f"{sum(actual.values())} rows vs {sum(expected.values())}; "
        f"only in Spark {sum(extra.values())}: {list(extra)[:3]}; "
        f"only in SQL {sum(lacking.values())}: {list(lacking)[:3]}"
    )
