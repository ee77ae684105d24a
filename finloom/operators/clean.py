"""Raw text to clean, typed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finloom.functions.columns import as_type, lenient_date
from finloom.functions.hot import hot_keys, is_hot
from finloom.layer import Layer
from finloom.schemas import CLEAN, KEYS


def parse_dates(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Parse the columns the schema declares as dates; the other columns pass through."""
    dates = {f.name for f in schema.fields if isinstance(f.dataType, T.DateType)}
    return df.selectExpr(*(f"{lenient_date(c)} AS {c}" if c in dates else c for c in df.columns))


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast raw text to the declared types in one projection; text that does not fit becomes NULL."""
    return df.selectExpr(*(f"{as_type(f.name, f.dataType)} AS {f.name}" for f in schema.fields))


def null_policy(df: DataFrame, keys: Sequence[str], fill_zero: Sequence[str] = ()) -> DataFrame:
    """Tag each row ``kept`` or ``rejected`` (a key is NULL) in ``disposition``.

    Measures stay NULL unless listed in ``fill_zero``. Both outcomes come from one pass over the rows.
    """
    complete = " AND ".join(f"{key} IS NOT NULL" for key in keys)
    tagged = df.withColumn("disposition", F.expr(f"CASE WHEN {complete} THEN 'kept' ELSE 'rejected' END"))
    return tagged.fillna(0, subset=list(fill_zero)) if fill_zero else tagged


def kept(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("disposition") == "kept").drop("disposition")


def rejected(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("disposition") == "rejected").drop("disposition")


def dedup(df: DataFrame, key: str, latest_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the latest by ``latest_by``, ties broken by all other columns.

    Rows with a NULL key have nothing in common and all stay: each is ranked by itself, in the same pass.
    The order is total over the columns, so exact duplicates collapse as well. Spark keeps one row per key in
    every map task before the shuffle (partial group limit), so a key that holds a large share of all rows
    reaches its reducer as one row per map task.
    """
    alone = df.withColumn("_alone", F.when(F.col(key).isNull(), F.monotonically_increasing_id()))
    rank = F.row_number().over(Window.partitionBy(key, "_alone").orderBy(*_order(df, key, latest_by)))
    return alone.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank", "_alone")


def _order(df: DataFrame, key: str, latest_by: Sequence[str]) -> list[Column]:
    """A key's rows in order, the one that stays first."""
    rest = [c for c in df.columns if c != key and c not in latest_by]
    order = [F.col(c).desc_nulls_last() for c in latest_by] + [F.col(c).asc_nulls_first() for c in rest]
    return order or [F.col(key)]


# A hot key's rows are ranked in this many parts before the parts' first rows are ranked against each other.
PARTS = 64


def rejects(clean: DataFrame, table: str, hot: Sequence[str] | None = None) -> DataFrame:
    """The rows that ``one_row_per_key`` takes out of a clean table, with the reason: together with what it keeps
    they are all rows.

    ``hot`` names the keys, as text, with a large share of the rows (``functions.hot.hot_keys``): they are ranked in parts,
    so no task sorts all rows of one, and the other rows move once. Without the list every key is ranked in parts, in one
    scan that moves all rows twice. The result is the same for any list.
    """
    key = KEYS[table]
    reason = F.when(F.col(key).isNull(), "null_key").otherwise("duplicate_key")
    if hot is None:
        out = _beaten_in_parts(clean, table)
    else:
        out = _beaten(clean.filter(~is_hot(key, hot)), table)
        if hot:
            out = out.unionByName(_beaten_in_parts(clean.filter(is_hot(key, hot)), table))
    return out.withColumn("reject_reason", reason)


def _beaten(rows: DataFrame, table: str) -> DataFrame:
    """All but the first row of each key, and the rows without one, which are dealt singly."""
    key = KEYS[table]
    alone = rows.withColumn("_alone", F.when(F.col(key).isNull(), F.monotonically_increasing_id()))
    place = F.row_number().over(Window.partitionBy(key, "_alone").orderBy(*_order(rows, key, LATEST_BY.get(table, ()))))
    beaten = (F.col("_place") > 1) | F.col(key).isNull()
    return alone.withColumn("_place", place).filter(beaten).drop("_place", "_alone")


def _beaten_in_parts(rows: DataFrame, table: str) -> DataFrame:
    """The same rows as ``_beaten``. A row that is not the first of its part of the key's rows is beaten for sure. The parts'
    first rows, at most PARTS a key, are ranked once more, while the others stay dealt by part."""
    key = KEYS[table]
    order = _order(rows, key, LATEST_BY.get(table, ()))
    number = F.monotonically_increasing_id()
    dealt = rows.withColumn("_part", F.when(F.col(key).isNull(), -1 - number).otherwise(number % PARTS))
    first = F.row_number().over(Window.partitionBy(key, "_part").orderBy(*order)) == 1
    dealt = dealt.withColumn("_part", F.when(first & (F.col("_part") >= 0), F.lit(-1)).otherwise(F.col("_part")))
    best = F.row_number().over(Window.partitionBy(key, "_part").orderBy(*order)) == 1
    dealt = dealt.withColumn("_stays", best & (F.col("_part") == -1) & F.col(key).isNotNull())
    return dealt.filter(~F.col("_stays")).drop("_part", "_stays")


# Fixed choice: of several rows with one key the one dated last is the current one.
LATEST_BY = {"general_ledgers": ("posting_date", "entry_date"), "payroll": ("pay_date",), "employee": ("hire_date",)}


def clean_table(raw: DataFrame, table: str, one_row_per_key: bool = False) -> DataFrame:
    """A raw table with dates parsed and types declared; on request without NULL keys and repeated keys."""
    clean = typed(raw, CLEAN[table])
    if one_row_per_key:
        clean = dedup(kept(null_policy(clean, [KEYS[table]])), KEYS[table], LATEST_BY.get(table, ()))
    return clean


def rejects_layer(raw: Layer) -> Layer:
    """The rejects of the six clean tables, as ``<table>_rejects``. Each table's hot keys are looked for when it is built."""

    def of(name: str) -> DataFrame:
        clean = clean_table(raw[name], name)
        return rejects(clean, name, hot_keys(clean, KEYS[name]))

    return Layer({f"{name}_rejects": lambda name=name: of(name) for name in CLEAN})


def clean_layer(raw: Layer, one_row_per_key: bool = False) -> Layer:
    """The six clean tables.

    Rows are kept as they came by default. ``one_row_per_key`` turns on the null policy and the deduplication,
    which gives every dimension the unique key the joins downstream assume.
    """
    return Layer({name: lambda name=name: clean_table(raw[name], name, one_row_per_key) for name in CLEAN})
