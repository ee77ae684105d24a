"""Dates, labels, casts and range rules.

Expressions are SQL text for ``selectExpr`` and ``F.expr``: the same Catalyst expressions as the Column API
gives, handed to the session in one call per column instead of one per operator.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the one date text the raw layer uses.
RAW_DATE_FORMAT = "dd-MM-yyyy HH:mm"


def named(**expressions: str) -> list[Column]:
    """Columns from SQL text, named by keyword."""
    return [F.expr(f"{sql} AS {name}") for name, sql in expressions.items()]


def lenient_date(column: str) -> str:
    """Date of a raw date text; NULL for anything that is not exactly day-month-year hour:minute.

    Text shorter than the format cannot match. It is sorted out by its length, which costs a tenth of a failed
    parse: date-only and empty texts are common in raw files.
    """
    shortest = len(RAW_DATE_FORMAT)
    return f"CASE WHEN length({column}) >= {shortest} THEN try_to_date({column}, '{RAW_DATE_FORMAT}') END"


def as_type(column: str, data_type: T.DataType) -> str:
    """Raw text to a declared type, NULL where the text does not fit."""
    if isinstance(data_type, T.StringType):
        return column
    if isinstance(data_type, T.DateType):
        return lenient_date(column)
    return f"try_cast({column} AS {data_type.simpleString()})"


def fiscal_month_label(year: str, period: str) -> str:
    """``2025-01``; NULL when either part is NULL, a period longer than two digits is cut to two."""
    return f"concat(CAST({year} AS STRING), '-', lpad(CAST({period} AS STRING), 2, '0'))"


def classify(column: str, rules: Iterable[tuple[str, int, int]], otherwise: str | None) -> str:
    """Name of the half-open range ``[low, high)`` that holds the value, else ``otherwise``."""
    cases = " ".join(f"WHEN {column} >= {low} AND {column} < {high} THEN '{name}'" for name, low, high in rules)
    return f"CASE {cases} ELSE {'NULL' if otherwise is None else repr(otherwise)} END"


def conform(df: DataFrame, schema: T.StructType, columns: Iterable[str] | None = None) -> DataFrame:
    """Project to a declared schema: given columns are cast, absent ones become typed NULLs.

    ``columns`` keeps a subset, in schema order.
    """
    wanted = set(schema.names if columns is None else columns)
    unknown = wanted - set(schema.names)
    if unknown:
        raise ValueError(f"not in the schema: {sorted(unknown)}")
    have = set(df.columns)
    return df.selectExpr(
        *(
            f"CAST({f.name if f.name in have else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in schema.fields
            if f.name in wanted
        )
    )
