"""Compare a Spark result with a DuckDB result: columns, types and every value."""

from __future__ import annotations

import datetime
from collections import Counter
from decimal import Decimal

SAMPLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in SAMPLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _kind(value):
    """Type and value: 1, True and Decimal(1) are three different things here."""
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, Decimal):
        return ("decimal", value.as_tuple().exponent, value)
    if isinstance(value, datetime.date):
        return ("date", value.isoformat())
    return (type(value).__name__, value)


def difference(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs first."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected_rows = cursor.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(set(names) ^ set(spark_df.columns))}"
    order = sorted(names)
    places = [names.index(n) for n in order]
    expected = Counter(tuple(_kind(row[i]) for i in places) for row in expected_rows)
    actual = Counter(tuple(_kind(v) for v in row) for row in spark_df.select(*order).collect())
    if expected == actual:
        return None
    only_spark, only_sql = actual - expected, expected - actual
    return (
        f"{sum(actual.values())} rows against {sum(expected.values())}; "
        f"only in Spark {list(only_spark)[:1]}, only in SQL {list(only_sql)[:1]} ({order})"
    )
