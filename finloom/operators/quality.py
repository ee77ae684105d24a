"""Data quality checks: one aggregate pass each, results are small tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finloom.functions.columns import as_type, named
from finloom.operators.clean import LATEST_BY, dedup


def null_counts(raw: DataFrame, schema: T.StructType, table: str) -> DataFrame:
    """Per column: rows, rows NULL after cleaning, and how many of those had text that did not parse.

    A value that parsed came from text that is there, so plain counts of values and of texts give all three.
    """

    def of_column(field: T.StructField) -> str:
        known = f"count({as_type(field.name, field.dataType)})"
        unparsed = "0L" if isinstance(field.dataType, T.StringType) else f"count(nullif({field.name}, '')) - {known}"
        return f"struct('{field.name}' AS column_name, count(*) - {known} AS n_null, {unparsed} AS n_unparsed)"

    columns = ", ".join(of_column(f) for f in schema.fields)
    counted = raw.agg(F.expr("count(*) AS n_rows"), F.expr(f"array({columns}) AS columns"))
    return counted.selectExpr(f"'{table}' AS table_name", "n_rows", "inline(columns)").select(
        "table_name", "column_name", "n_rows", "n_null", "n_unparsed"
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(key).agg(F.expr("count(*) AS n_rows")).filter("n_rows > 1")


def duplicate_keys_of(tables: Mapping[str, DataFrame], keys: Mapping[str, str]) -> DataFrame:
    """Repeated keys of several tables, keys as text. A NULL key counts like any other."""
    found = [
        duplicate_keys(tables[name], key).selectExpr(f"'{name}' AS table_name", f"CAST({key} AS STRING) AS key_value", "n_rows")
        for name, key in keys.items()
    ]
    return reduce(DataFrame.unionByName, found)


def orphans(fact: DataFrame, name: str, references: Mapping[str, DataFrame]) -> DataFrame:
    """Foreign key values without a dimension row, with the fact rows that carry them.

    ``references`` maps a fact column to the dimension that has it as key. The fact is read once, with one
    grouping set per foreign key: rows are counted per key value before any of them moves, so hot keys are gone
    by the shuffle and the join.
    """
    keys = list(references)
    per_value = fact.groupingSets([[fk] for fk in keys], *keys).agg(
        *named(n_rows="count(*)", **{f"_without_{fk}": f"grouping({fk})" for fk in keys})
    )
    which = " ".join(f"WHEN _without_{fk} = 0 THEN '{fk}'" for fk in keys)
    value = ", ".join(f"CAST({fk} AS STRING)" for fk in keys)
    used = per_value.selectExpr(
        f"CASE {which} END AS foreign_key", f"coalesce({value}, CAST(NULL AS STRING)) AS key_value", "n_rows"
    ).filter("key_value IS NOT NULL")
    known = [
        dimension.selectExpr(f"'{fk}' AS foreign_key", f"CAST({fk} AS STRING) AS key_value", "true AS known")
        for fk, dimension in references.items()
    ]
    # An outer join rather than an anti join: Spark moves a broadcast anti join below the count, back onto the
    # fact rows.
    looked_up = used.join(reduce(DataFrame.unionByName, known), ["foreign_key", "key_value"], "left")
    missing = looked_up.filter("known IS NULL")
    return missing.selectExpr(f"'{name}' AS fact_name", "foreign_key", "key_value", "n_rows")


def reconcile(table: str, clean: DataFrame, key: str, in_fact: str, fact: DataFrame) -> DataFrame:
    """Row counts from raw to fact of one table, and the fact counted on its own.

    raw = kept + rejected (NULL key) + duplicate (all but one row of a key); kept = fact + excluded, the kept rows that
    the fact's filter ``in_fact`` leaves out. Rows and distinct keys come from one aggregate over the key alone; kept and
    excluded from the deduplicated rows, of which a hot key has one per map task.
    """
    counts = ("n_raw", "n_kept", "n_rejected", "n_duplicate", "n_fact", "n_excluded")

    def part(rows: DataFrame, **found: str) -> DataFrame:
        return rows.agg(*named(**{name: found.get(name, "0L") for name in counts}))

    keyed = f"count({key}) - count(DISTINCT {key})"
    kept = dedup(clean.filter(f"{key} IS NOT NULL"), key, LATEST_BY.get(table, ()))
    outside = f"count_if(NOT coalesce({in_fact}, false))"
    parts = [
        part(clean, n_raw="count(*)", n_rejected=f"count(*) - count({key})", n_duplicate=keyed),
        part(kept, n_kept="count(*)", n_excluded=outside),
        part(fact, n_fact="count(*)"),
    ]
    total = reduce(DataFrame.unionByName, parts).agg(*named(**{name: f"sum({name})" for name in counts}))
    balanced = "n_raw = n_kept + n_rejected + n_duplicate AND n_kept = n_fact + n_excluded"
    return total.selectExpr(f"'{table}' AS table_name", "*", f"{balanced} AS balanced")


class ObservedNulls:
    """Null counts taken while a table is written, at no scan of its own.

    ``rows`` are the raw rows, to be written on as any others; once a write over them has ended, ``counts`` has one row per
    column, the same as ``null_counts`` gives. A write that reads them twice, or in part, would count as it read.
    """

    def __init__(self, raw: DataFrame, schema: T.StructType, table: str):
        self.schema, self.table, self._seen = schema, table, Observation()
        found = ["count(*) AS n_rows"]
        for k, field in enumerate(schema.fields):
            found.append(f"count({as_type(field.name, field.dataType)}) AS known_{k}")
            found.append(f"count(nullif({field.name}, '')) AS told_{k}")
        self.rows = raw.observe(self._seen, *(F.expr(x) for x in found))

    def counts(self) -> list[tuple[str, str, int, int, int]]:
        seen = self._seen.get  # waits for the write
        out = []
        for k, field in enumerate(self.schema.fields):
            known = seen[f"known_{k}"]
            unparsed = 0 if isinstance(field.dataType, T.StringType) else seen[f"told_{k}"] - known
            out.append((self.table, field.name, seen["n_rows"], seen["n_rows"] - known, unparsed))
        return out


NULL_COUNTS = "table_name string, column_name string, n_rows bigint, n_null bigint, n_unparsed bigint"


def observed_counts(spark: SparkSession, observed: Iterable[ObservedNulls]) -> DataFrame:
    """The counts of several written tables, a row per column of the data model."""
    return spark.createDataFrame([row for one in observed for row in one.counts()], NULL_COUNTS)
