"""Clean rows to analysis-ready rows: unused columns out, derived columns in."""

from __future__ import annotations

from pyspark.sql import DataFrame

from finloom.functions.columns import fiscal_month_label
from finloom.functions.money import add_up, money
from finloom.layer import Layer
from finloom.schemas import DEDUCTIONS, PAY_PARTS, SILVER


def _project(df: DataFrame, table: str, **derived: str) -> DataFrame:
    """The silver columns of a table, computed from ``derived`` or taken as they are."""
    return df.selectExpr(*(f"{derived[c]} AS {c}" if c in derived else c for c in SILVER[table].names))


def accounts(clean: DataFrame) -> DataFrame:
    return _project(clean, "accounts")


def company(clean: DataFrame) -> DataFrame:
    return clean


def departments(clean: DataFrame) -> DataFrame:
    return _project(clean, "departments")


def employee(clean: DataFrame) -> DataFrame:
    """Full name from the parts that are known (empty when none is)."""
    return _project(clean, "employee", FullName="concat_ws(' ', first_name, last_name)")


def general_ledgers(clean: DataFrame) -> DataFrame:
    return _project(
        clean,
        "general_ledgers",
        net_amount=money("credit_amount - debit_amount"),
        fiscal_month_label=fiscal_month_label("fiscal_year", "fiscal_period"),
    )


def payroll(clean: DataFrame) -> DataFrame:
    """Totals over the pay parts and deductions; the fiscal month is that of the pay date."""
    return _project(
        clean,
        "payroll",
        total_compensation=add_up(PAY_PARTS),
        total_deductions=add_up(DEDUCTIONS),
        fiscal_year="year(pay_date)",
        fiscal_period="month(pay_date)",
        fiscal_month_label=fiscal_month_label("year(pay_date)", "month(pay_date)"),
    )


_BUILD = {
    "accounts": accounts,
    "company": company,
    "departments": departments,
    "employee": employee,
    "general_ledgers": general_ledgers,
    "payroll": payroll,
}


def silver_layer(clean: Layer) -> Layer:
    return Layer({name: lambda name=name, f=f: f(clean[name]) for name, f in _BUILD.items()})
