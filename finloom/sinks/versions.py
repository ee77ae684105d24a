"""Tables that are replaced in one step.

A versioned table is a view that names one stored version. A replacement writes a version of its own beside the others,
checks that all rows have arrived, and only then turns the view: readers see all old rows or all new ones, a write that
fails leaves the old ones, and rows may be derived from the table they replace. The last versions stay for going back.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from finloom.sinks.tables import overwrite_table, quoted

_PROPERTY = "finloom.version"


def versions(spark: SparkSession, table: str) -> list[str]:
    """The stored versions of a table, the oldest first."""
    schema, name = table.rsplit(".", 1)
    found = spark.sql(f"SHOW TABLES IN {quoted(schema)} LIKE '{name}__v*'").collect()  # a row per version
    mine = re.compile(re.escape(name) + r"__v(\d+)_[0-9a-f]+", re.IGNORECASE)
    named = [(int(m[1]), r["tableName"]) for r in found if (m := mine.fullmatch(r["tableName"]))]
    return [f"{schema}.{n}" for _, n in sorted(named)]


def current_version(spark: SparkSession, table: str) -> str | None:
    """The version that the table shows, None if there is no such table yet."""
    if not spark.catalog.tableExists(quoted(table)):
        return None
    found = spark.sql(f"SHOW TBLPROPERTIES {quoted(table)}").filter(F.col("key") == _PROPERTY).collect()
    if not found:
        raise ValueError(f"{table} exists and is not versioned; adopt it first")
    return found[0]["value"]


def _show(spark: SparkSession, table: str, version: str) -> None:
    """The one step: the catalog replaces the view's definition."""
    spark.sql(
        f"CREATE OR REPLACE VIEW {quoted(table)} TBLPROPERTIES ('{_PROPERTY}' = '{version}') AS SELECT * FROM {quoted(version)}"
    )


def _fresh(spark: SparkSession, table: str) -> str:
    known = versions(spark, table)
    n = int(known[-1].rsplit("__v", 1)[1].split("_")[0]) + 1 if known else 1
    return f"{table}__v{n:06d}_{uuid.uuid4().hex[:8]}"


def replace_table(
    df: DataFrame, table: str, table_format: str = "parquet", partition_by: Sequence[str] = (), keep: int = 2
) -> str:
    """Replace the rows that ``table`` shows; returns the new version. ``keep`` versions stay, the new one included."""
    spark = df.sparkSession
    current_version(spark, table)  # refuses a plain table before anything is written
    version, written = _fresh(spark, table), Observation()
    try:
        overwrite_table(df.observe(written, F.count(F.lit(1)).alias("n")), version, table_format, partition_by)
        expected, found = written.get["n"], spark.table(quoted(version)).count()
        if found != expected:
            raise RuntimeError(f"{version} holds {found} rows of {expected}")
        _show(spark, table, version)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(version)}")
        raise
    forget(spark, table, keep)
    return version


def roll_back(spark: SparkSession, table: str, steps: int = 1) -> str:
    """Show an earlier version again; later ones stay until the next replacement forgets them."""
    known, now = versions(spark, table), current_version(spark, table)
    at = known.index(now) - steps
    if at < 0:
        raise ValueError(f"{table} has no version {steps} before {now}")
    _show(spark, table, known[at])
    return known[at]


def forget(spark: SparkSession, table: str, keep: int) -> None:
    """Drop versions older than the last ``keep``, never the one that is shown."""
    now = current_version(spark, table)
    for version in versions(spark, table)[: -max(keep, 1)]:
        if version != now:
            spark.sql(f"DROP TABLE IF EXISTS {quoted(version)}")


def adopt(spark: SparkSession, table: str) -> str:
    """Make a plain table the first version of a versioned one of the same name."""
    version = _fresh(spark, table)
    spark.sql(f"ALTER TABLE {quoted(table)} RENAME TO {quoted(version)}")
    _show(spark, table, version)
    return version
