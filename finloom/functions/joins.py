"""Joining a fact to a dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dimension is sent to every executor only if it was counted to stay under both bounds.
BROADCAST_MAX_ROWS = 500_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def is_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Count rows and text bytes in one aggregate; only the two totals reach the driver."""
    width = " + ".join(f"coalesce(octet_length(CAST({c} AS STRING)), 0) + 8" for c in df.columns)
    seen = df.agg(F.expr("count(*) AS n"), F.expr(f"coalesce(sum({width}), 0) AS b")).first()
    return seen["n"] <= max_rows and seen["b"] <= max_bytes


def lookup(fact: DataFrame, dimension: DataFrame, on: str, how: str = "left", small: bool | None = None) -> DataFrame:
    """Join a fact to a dimension whose size Spark cannot read off a file.

    Measured small, the dimension is broadcast and the fact keeps its partitioning. Otherwise the join is left
    to Spark: a sort-merge join whose hot keys adaptive execution splits. ``small`` is the verdict of a measurement
    made before.
    """
    fits = is_small(dimension) if small is None else small
    return fact.join(F.broadcast(dimension) if fits else dimension, on, how)
