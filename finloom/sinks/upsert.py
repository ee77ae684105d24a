"""Tables with one row per key that take in late batches.

Rows are stored by ranges of their key. A batch is merged into the ranges that its own keys fall into; files of other
ranges are neither read nor written. What stays of several rows with one key is what deduplicating everything that ever
came would leave, in whichever order the batches came.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finloom.operators.clean import dedup
from finloom.sinks.tables import quoted

RANGE = "_key_range"
_WIDTH = "finloom.key_width"


def _ranged(df: DataFrame, key: str, width: int) -> DataFrame:
    """Rows with the number of their range of keys; NULL for a NULL key."""
    return df.withColumn(RANGE, F.floor(F.col(key) / F.lit(width)).cast("bigint"))


def create_keyed(
    df: DataFrame, table: str, key: str, width: int, latest_by: Sequence[str] = (), table_format: str = "parquet"
) -> None:
    """Store one row per key, ``width`` neighbouring keys to a partition; rows without a key all stay."""
    rows = dedup(_ranged(df, key, width), key, latest_by).hint("rebalance", RANGE)
    (
        rows.write.mode("overwrite")
        .format(table_format)
        .partitionBy(RANGE)
        .option("partitionOverwriteMode", "dynamic")  # an option of the table: inserts replace what they touch
        .saveAsTable(quoted(table))
    )
    df.sparkSession.sql(f"ALTER TABLE {quoted(table)} SET TBLPROPERTIES ('{_WIDTH}' = '{width}')")


def _in_ranges(ranges: Sequence[int | None]) -> Column:
    known = [r for r in ranges if r is not None]
    inside = F.col(RANGE).isin(known)
    return inside | F.col(RANGE).isNull() if None in ranges else inside


def upsert(batch: DataFrame, table: str, key: str, latest_by: Sequence[str] = ()) -> list[int | None]:
    """Merge a batch into a table made by ``create_keyed``; returns the ranges that were rewritten.

    The batch's ranges are collected, no more of them than the table gets partitions. Running it again changes nothing but
    rows without a key, which have no identity and are added again.
    """
    spark = batch.sparkSession
    width = int(spark.sql(f"SHOW TBLPROPERTIES {quoted(table)} ('{_WIDTH}')").first()["value"])
    stored, rows = spark.table(quoted(table)), _ranged(batch, key, width)
    touched = [r[0] for r in rows.select(RANGE).distinct().collect()]
    if not touched:
        return []
    merged = dedup(stored.filter(_in_ranges(touched)).unionByName(rows), key, latest_by)
    merged.select(*stored.columns).hint("rebalance", RANGE).write.mode("overwrite").insertInto(quoted(table))
    return sorted(touched, key=lambda r: (r is not None, r))
