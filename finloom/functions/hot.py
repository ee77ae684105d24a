"""Keys that hold a large share of a table's rows.

A frequent-items sketch, merged from one small sketch per task, names the candidates; its size depends on the share asked
for, not on the rows or the keys. It misses no key that has the share: with a map of more than 16 times ``one_in`` entries
its error stays under a quarter of the share, and at most twice ``one_in`` keys can come near it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ONE_IN = 100


def _candidates(df: DataFrame, columns: Sequence[str], one_in: int) -> tuple[int, dict[str, list[tuple[str, int]]]]:
    """Number of rows; per column the keys, as text, that may hold the share, with their estimated rows."""
    if one_in < 1:
        raise ValueError("one_in must be 1 or more")
    sketches = [F.expr(f"approx_top_k(CAST({c} AS STRING), {2 * one_in}, {16 * one_in})").alias(c) for c in columns]
    seen = df.agg(F.expr("count(*) AS _rows"), *sketches).first()
    found = {c: [(item["item"], item["count"]) for item in seen[c] or [] if item["item"] is not None] for c in columns}
    return seen["_rows"], found


def hot_keys(df: DataFrame, key: str, one_in: int = ONE_IN) -> list[str]:
    """Keys, as text, that hold at least one in ``one_in`` rows, and perhaps some that hold nearly as many.

    One pass over the key column; at most ``2 * one_in`` keys come back. NULL is no key. For planning only: whatever is
    built on the list must be right for any list.
    """
    n, found = _candidates(df, [key], one_in)
    return sorted(item for item, count in found[key] if count * one_in >= n)


def is_hot(key: str, hot: Sequence[str]) -> Column:
    """Whether a row's key is in a list of ``hot_keys``; false for a NULL key."""
    return F.coalesce(F.col(key).cast("string").isin(list(hot)), F.lit(False)) if hot else F.lit(False)


def frequent_keys(df: DataFrame, table: str, columns: Sequence[str], one_in: int = ONE_IN) -> DataFrame:
    """Exactly the values of each column that hold at least one in ``one_in`` rows, with their rows.

    The sketch only decides which values are counted; counts are of all rows, NULL being a value like any other. Rows are
    counted per task before they move, and no more values than twice ``one_in`` a column are.
    """
    n, found = _candidates(df, columns, one_in)
    pairs = ", ".join(f"struct('{c}' AS column_name, CAST({c} AS STRING) AS key_value)" for c in columns)
    values = df.selectExpr(f"inline(array({pairs}))")
    wanted = [
        (F.col("column_name") == c) & (F.col("key_value").isNull() | F.col("key_value").isin([item for item, _ in found[c]]))
        for c in columns
    ]
    counted = values.filter(reduce(Column.__or__, wanted)).groupBy("column_name", "key_value")
    frequent = counted.agg(F.expr("count(*) AS n_rows")).filter(F.col("n_rows") * one_in >= n)
    return frequent.selectExpr(f"'{table}' AS table_name", "column_name", "key_value", "n_rows", f"{n}L AS n_all")
