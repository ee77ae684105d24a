"""Star schema: four dimensions and two facts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from finloom.functions.columns import classify
from finloom.functions.joins import lookup
from finloom.layer import Layer
from finloom.schemas import MART

# Account number ranges, low included, high excluded.
PL_SECTIONS = (
    ("Revenue", 4000, 5000),
    ("COGS", 5000, 6000),
    ("Operating Expense", 6000, 7100),
    ("Tax", 7100, 7200),
)
OUTSIDE_PL = "Balance Sheet"

# Operating expense categories, one hundred account numbers each from 6000 up.
OPEX_CATEGORIES = (
    "Personnel",
    "Occupancy",
    "Technology",
    "Marketing",
    "Travel & Entertainment",
    "Professional Fees",
    "Communications",
    "Financial Charges",
    "Depreciation & Amortisation",
    "Other Operating",
    "R&D",
)
OPEX_RANGES = tuple((name, 6000 + 100 * i, 6100 + 100 * i) for i, name in enumerate(OPEX_CATEGORIES))

POSTED = "Posted"
FACT_PARTITIONS = ("fiscal_year", "company_id")


def dim_account(accounts: DataFrame) -> DataFrame:
    """Accounts with their P&L section and operating expense category."""
    return accounts.selectExpr(
        "*",
        f"{classify('account_id', PL_SECTIONS, OUTSIDE_PL)} AS pl_section",
        f"{classify('account_id', OPEX_RANGES, None)} AS opex_category",
    )


def fact_gl(general_ledgers: DataFrame, accounts_dim: DataFrame, small: bool | None = None) -> DataFrame:
    """Posted ledger lines with the attributes of their account; NULL attributes for an unknown account."""
    attributes = accounts_dim.select("account_id", "pl_section", "opex_category", "account_type", "account_name")
    return lookup(general_ledgers.filter(f"status = '{POSTED}'"), attributes, "account_id", small=small)


def mart_layer(silver: Layer, dimensions: Layer | None = None) -> Layer:
    """The star schema over silver tables; ``dimensions`` supplies an account dimension already stored."""
    frames = {
        "dim_account": lambda: dim_account(silver["accounts"]),
        "dim_departments": lambda: silver["departments"],
        "dim_employee": lambda: silver["employee"],
        "dim_company": lambda: silver["company"],
        "fact_gl": lambda: fact_gl(
            silver["general_ledgers"],
            (dimensions or mart)["dim_account"],
            (dimensions or mart).is_small("dim_account"),
        ),
        "fact_payroll": lambda: silver["payroll"],
    }
    mart = Layer({name: lambda name=name, f=f: f().select(*MART[name].names) for name, f in frames.items()})
    return mart
