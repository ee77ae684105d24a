"""Tables and views in the session catalog."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CONCURRENT_WRITES = 8


def quoted(name: str) -> str:
    """A name of one to three parts (catalog, schema, table), each part quoted; a name that has quotes already stays."""
    return name if "`" in name else ".".join(f"`{part}`" for part in name.split("."))


def ensure_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(schema)}")


def overwrite_table(df: DataFrame, table: str, table_format: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Replace a managed table with the rows of ``df``.

    For a partitioned table the rows are first rebalanced on the partition columns: each partition gets few
    files, and adaptive execution cuts a partition that holds a large share of all rows into several tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("overwrite").format(table_format).partitionBy(*partition_by).saveAsTable(quoted(table))


def write_together(spark: SparkSession, writes: Iterable[Callable[[], None]]) -> None:
    """Start independent writes at once: the small ones fill executors that the tail of a large one leaves idle.

    The first failure is raised after the running writes have ended.
    """
    with ThreadPoolExecutor(CONCURRENT_WRITES) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(write)) for write in writes]:
            done.result()


def replace_partitions(df: DataFrame, table: str, fixed: Mapping[str, object]) -> None:
    """Replace all partitions of ``table`` that have the ``fixed`` values (re-run of one fiscal year) with the rows
    of ``df`` that have them; partitions of those values that ``df`` no longer has are emptied as well.

    ``fixed`` names the first partition columns, in order. The values are part of the statement, so no session setting
    changes and other writes may run beside it; the session's partition overwrite mode must be static, its default.
    """
    spark = df.sparkSession
    columns = spark.catalog.listColumns(quoted(table))
    partitions = [c.name for c in columns if c.isPartition]
    if list(fixed) != partitions[: len(fixed)]:
        raise ValueError(f"{table} is partitioned by {partitions}, not first by {list(fixed)}")
    rest = partitions[len(fixed) :]
    for name, value in fixed.items():
        df = df.filter(F.col(name) == F.lit(value))
    rows = df.select(*(c.name for c in columns if c.name not in fixed))
    rows = rows.hint("rebalance", *rest) if rest else rows.hint("rebalance")
    values = [f"{quoted(name)} = {value!r}" for name, value in fixed.items()]
    target = f"{quoted(table)} PARTITION ({', '.join([*values, *map(quoted, rest)])})"
    spark.sql(f"INSERT OVERWRITE TABLE {target} SELECT * FROM {{rows}}", rows=rows)


def publish_temp_views(frames: Mapping[str, DataFrame]) -> None:
    """Register session views under the given names."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def publish_views(spark: SparkSession, schema: str, views: Mapping[str, str]) -> None:
    """Persistent views: view name -> stored table it shows."""
    ensure_schema(spark, schema)
    for view, table in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW {quoted(f'{schema}.{view}')} AS SELECT * FROM {quoted(table)}")
