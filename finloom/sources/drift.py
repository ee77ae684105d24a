"""Stored tables whose columns are no longer the declared ones.

Files and tables change under a pipeline: a column goes, comes, is spelt otherwise or gets another type. Rows are brought
back to the declared schema where that loses nothing, what was done is recorded, and anything that would lose values stops
the run before it is read.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finloom.layer import Layer
from finloom.sinks.tables import quoted
from finloom.sources.files import AUDIT_COLUMNS

MISSING, EXTRA, RENAMED, CONVERTED = "missing", "extra", "renamed", "converted"
FINDINGS = (
    "table_name string, column_name string, finding string, declared_type string, stored_type string, n_values bigint"
)

# Decimal digits that hold every value of an integer type, in the order of their width.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


class SchemaDrift(ValueError):
    """A stored column cannot be read as declared without losing values."""


@dataclass(frozen=True)
class Finding:
    """One difference; ``stored`` is the stored column's own name, none for a missing one."""

    column: str
    kind: str
    declared: str | None = None
    stored: str | None = None
    stored_type: str | None = None


def _ticked(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def loses_nothing(stored: T.DataType, declared: T.DataType) -> bool:
    """Whether every value of the stored type has its own value in the declared one.

    As text go whole numbers, decimals and truth values. Dates, times and floating numbers do not: their text depends on
    who prints it, and the clean layer reads dates in one form only.
    """
    if stored == declared or isinstance(stored, T.NullType):
        return True
    digits = _DIGITS.get(type(stored))
    if isinstance(declared, T.StringType):
        return digits is not None or isinstance(stored, (T.DecimalType, T.BooleanType, T.CharType, T.VarcharType))
    if type(declared) in _DIGITS:
        return digits is not None and digits <= _DIGITS[type(declared)]
    if isinstance(declared, T.DecimalType):
        if digits is not None:
            return digits <= declared.precision - declared.scale
        if isinstance(stored, T.DecimalType):
            whole = stored.precision - stored.scale <= declared.precision - declared.scale
            return whole and stored.scale <= declared.scale
    return False


def _matched(stored: T.StructType, declared: T.StructType) -> dict[str, T.StructField]:
    """Declared name to the stored column that stands for it: the same name, else the first that differs only in case
    and outer blanks."""
    exact = {f.name: f for f in stored.fields}
    folded: dict[str, T.StructField] = {}
    for field in stored.fields:
        if field.name not in declared.names:
            folded.setdefault(field.name.strip().lower(), field)
    found = {name: exact.get(name) or folded.get(name.lower()) for name in declared.names}
    return {name: field for name, field in found.items() if field is not None}


def compare(stored: T.StructType, declared: T.StructType, expected: Iterable[str] = ()) -> list[Finding]:
    """Differences between a stored schema and the declared one, in declared order, then columns nobody declared.

    ``expected`` columns may be there beside the declared ones. Raises `SchemaDrift`, naming all of them, if columns cannot
    be read as declared.
    """
    matched, found, refused = _matched(stored, declared), [], []
    for want in declared.fields:
        have, want_type = matched.get(want.name), want.dataType.simpleString()
        if have is None:
            found.append(Finding(want.name, MISSING, want_type))
            continue
        have_type = have.dataType.simpleString()
        if not loses_nothing(have.dataType, want.dataType):
            refused.append(f"{have.name} is {have_type}, declared {want_type}")
        if have.name != want.name:
            found.append(Finding(want.name, RENAMED, want_type, have.name, have_type))
        if have.dataType != want.dataType:
            found.append(Finding(want.name, CONVERTED, want_type, have.name, have_type))
    if refused:
        raise SchemaDrift("; ".join(refused))
    taken = {field.name for field in matched.values()} | set(expected)
    rest = [f for f in stored.fields if f.name not in taken]
    return found + [Finding(f.name, EXTRA, None, f.name, f.dataType.simpleString()) for f in rest]


def conformed(df: DataFrame, declared: T.StructType) -> DataFrame:
    """The rows under the declared columns alone, in order: missing ones as typed NULLs. One projection, so a scan reads
    only what is there; raises `SchemaDrift` as `compare` does."""
    compare(df.schema, declared)
    matched = _matched(df.schema, declared)
    columns = []
    for want in declared.fields:
        have = matched.get(want.name)
        value = F.lit(None) if have is None else F.col(_ticked(have.name))
        same = have is not None and have.dataType == want.dataType
        columns.append((value if same else value.cast(want.dataType)).alias(want.name))
    return df.select(*columns)


def findings(spark: SparkSession, tables: Mapping[str, DataFrame], schemas: Mapping[str, T.StructType]) -> DataFrame:
    """A row per difference, with the stored values that are not NULL: for an undeclared column, what is left out.

    A table without a difference is not read; the others once, only the columns that differ.
    """
    rows: list[tuple] = []
    for name, df in tables.items():
        found = compare(df.schema, schemas[name], AUDIT_COLUMNS)
        stored = list(dict.fromkeys(f.stored for f in found if f.stored is not None))
        counts = [F.count(F.col(_ticked(c))).alias(f"n{k}") for k, c in enumerate(stored)]
        told = dict(zip(stored, df.agg(*counts).first(), strict=True)) if stored else {}
        rows += [(name, f.column, f.kind, f.declared, f.stored_type, told.get(f.stored, 0)) for f in found]
    return spark.createDataFrame(rows, FINDINGS)


def stored_as_declared(spark: SparkSession, schema: str, schemas: Mapping[str, T.StructType]) -> Layer:
    """The tables of a catalog schema, each under its declared columns."""
    stored = Layer.stored(spark, schema, schemas)
    return Layer({name: lambda name=name: conformed(stored[name], schemas[name]) for name in schemas})
