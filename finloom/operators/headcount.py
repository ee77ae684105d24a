"""Exact headcounts that add up over time: stored bitmaps of employees instead of counts.

A count of distinct employees of two months does not follow from the two months' counts; their bitmaps can be merged. One
row per month, company and bucket of 32,768 neighbouring employee numbers holds a bit for each of them, so quarters and
years are answered from the bitmaps, at a few kilobytes a bucket, without reading payroll again.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from finloom.functions.columns import named

BITMAPS = "payroll_headcount"
MONTHLY = ("fiscal_year", "fiscal_period", "company_id")

# Periods to roll up to, as columns over a month's row.
QUARTER = {"fiscal_year": "fiscal_year", "fiscal_quarter": "CAST((fiscal_period + 2) div 3 AS INT)"}
YEAR = {"fiscal_year": "fiscal_year", "fiscal_quarter": "CAST(NULL AS INT)"}


def monthly_bitmaps(fact_payroll: DataFrame) -> DataFrame:
    """Employees paid per month and company. Rows without an employee count nobody and leave no bitmap.

    Bits are set within each map task before the shuffle, so a hot company or employee moves as one bitmap per task."""
    paid = fact_payroll.filter("employee_id IS NOT NULL")
    return (
        paid.selectExpr(*MONTHLY, "bitmap_bucket_number(employee_id) AS bucket", "bitmap_bit_position(employee_id) AS bit")
        .groupBy(*MONTHLY, "bucket")
        .agg(*named(employees="bitmap_construct_agg(bit)"))
    )


def headcount(bitmaps: DataFrame, period: Mapping[str, str], *keys: str) -> DataFrame:
    """Distinct employees per period and ``keys``, from stored bitmaps."""
    merged = (
        bitmaps.selectExpr(*(f"{sql} AS {name}" for name, sql in period.items()), *keys, "bucket", "employees")
        .groupBy(*period, *keys, "bucket")
        .agg(*named(employees="bitmap_or_agg(employees)"))
    )
    return merged.groupBy(*period, *keys).agg(*named(headcount="sum(bitmap_count(employees))"))


def headcount_rollup(bitmaps: DataFrame) -> DataFrame:
    """Headcount per company by quarter and by year (``fiscal_quarter`` NULL)."""
    return headcount(bitmaps, QUARTER, "company_id").unionByName(headcount(bitmaps, YEAR, "company_id"))
