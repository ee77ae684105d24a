"""Tables stored by hash of a key, so that joins and groupings on it need no shuffle.

A bucket is read by one task, and adaptive execution cannot cut it as it cuts a shuffle's partition. Keys that hold a large
share of the rows are therefore stored apart, in ``<table>_hot``, evenly spread; what is bucketed has no such key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.functions.hot import hot_keys, is_hot
from finloom.sinks.tables import overwrite_table, quoted

ROWS_PER_BUCKET = 4_000_000
MAX_BUCKETS = 65_536
MAX_HOT = 1000  # keys below one in so many rows stay in their bucket
_KEY = "finloom.bucket_key"


def bucket_count(n_rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """A power of two that leaves about ``rows_per_bucket`` rows, at most, to a bucket. The larger side of a join decides."""
    need = max(1, -(-n_rows // rows_per_bucket))
    return min(MAX_BUCKETS, 1 << (need - 1).bit_length())


@dataclass(frozen=True)
class Bucketed:
    """A stored table: ``cold`` is bucketed by ``key``, ``hot`` holds the rows of ``hot_keys`` (none without such keys)."""

    key: str
    cold: DataFrame
    hot: DataFrame | None
    hot_keys: tuple[str, ...]

    @property
    def rows(self) -> DataFrame:
        """All rows; groupings by key need no shuffle where no key is hot."""
        return self.cold if self.hot is None else self.cold.unionByName(self.hot)


def store_bucketed(
    df: DataFrame, table: str, key: str, buckets: int, hot: Sequence[str] | None = None, table_format: str = "parquet"
) -> Bucketed:
    """Store ``df`` in ``buckets`` files sorted by ``key``, without its hot keys, which are found if not given: keys with
    more rows than an average bucket has, or one in MAX_HOT of all. Rows without a key join nothing and are spread with the
    hot ones.

    ``hot=()`` is for a table with one row per key. Rows are moved once, by the hash that names their bucket, so each
    bucket is one file and its order is that of the table.
    """
    spark = df.sparkSession
    hot = hot_keys(df, key, max(2, min(buckets, MAX_HOT))) if hot is None else hot
    apart = is_hot(key, hot) | F.col(key).isNull()
    cold = df.filter(~apart).repartition(buckets, key)
    (
        cold.write.mode("overwrite")
        .format(table_format)
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(quoted(table))
    )
    overwrite_table(df.filter(apart).hint("rebalance"), f"{table}_hot", table_format)
    spark.sql(f"ALTER TABLE {quoted(table)} SET TBLPROPERTIES ('{_KEY}' = '{key}')")
    return bucketed(spark, table)


def bucketed(spark: SparkSession, table: str) -> Bucketed:
    """A table that ``store_bucketed`` wrote. Its hot keys are read off the hot rows; at most twice MAX_HOT of them."""
    key = spark.sql(f"SHOW TBLPROPERTIES {quoted(table)} ('{_KEY}')").first()["value"]
    hot = spark.table(quoted(f"{table}_hot"))
    keys = [r[0] for r in hot.select(F.col(key).cast("string")).distinct().collect()]
    return Bucketed(key, spark.table(quoted(table)), hot if keys else None, tuple(k for k in keys if k is not None))
