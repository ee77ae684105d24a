"""The integrated cube: payroll and ledger rows side by side, denormalised and tagged."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finloom.functions.columns import conform, named
from finloom.functions.hot import is_hot
from finloom.functions.joins import is_small
from finloom.layer import Layer
from finloom.schemas import CUBE
from finloom.sinks.buckets import Bucketed

PAYROLL = "PAYROLL"
GENERAL_LEDGER = "GENERAL_LEDGER"

# Cube column -> dimension column. Keys are taken from the dimension, so a fact row without a
# match carries a NULL key.
_EMPLOYEE = {
    "employee_id": "employee_id",
    "employee_name": "FullName",
    "employee_email": "email",
    "employee_position": "position",
    "hire_date": "hire_date",
    "termination_date": "termination_date",
    "employee_base_salary": "base_salary",
    "employee_is_active": "is_active",
}
_DEPARTMENT = {"department_id": "department_id", "department_name": "department_name", "cost_center": "cost_center"}
_COMPANY = {
    "company_id": "company_id",
    "company_name": "company_name",
    "industry": "industry",
    "country": "country",
    "company_established_date": "established_date",
    "company_is_active": "is_active",
}
_ACCOUNT = {
    "account_id": "account_id",
    "account_name": "account_name",
    "account_type": "account_type",
    "account_category": "category",
}


def _attach(
    df: DataFrame,
    dimension: DataFrame,
    key: str,
    attributes: Mapping[str, str],
    wanted: set[str],
    small: bool = False,
) -> DataFrame:
    """Left join a dimension's wanted attributes; no join at all when none is wanted.

    Dimension keys are unique, so leaving the join out changes no row. The fact's own columns of the same
    names give way to the dimension's.
    """
    picked = {name: source for name, source in attributes.items() if name in wanted}
    kept = [c for c in df.columns if c not in attributes]
    if not picked:
        return df.select(*kept)
    fact_key, dim_key = f"_fact_{key}", f"_dim_{key}"
    side = dimension.selectExpr(f"{key} AS {dim_key}", *(f"{source} AS {name}" for name, source in picked.items()))
    if small:
        side = F.broadcast(side)
    return df.selectExpr(f"{key} AS {fact_key}", *kept).join(side, F.expr(f"{fact_key} = {dim_key}"), "left")


def _wanted(columns: Iterable[str] | None) -> set[str]:
    return set(CUBE.names if columns is None else columns)


def payroll_branch(mart: Layer, columns: Iterable[str] | None = None, fact: DataFrame | None = None) -> DataFrame:
    """Payroll rows with their employee, department and company; ledger columns are typed NULLs.

    ``columns`` limits the output and the joins to what is asked for.
    """
    wanted = _wanted(columns)
    df = (mart["fact_payroll"] if fact is None else fact).withColumnsRenamed(
        {"payroll_id": "transaction_id", "pay_date": "transaction_date"}
    )
    # The workforce grows with the data: its join is left to Spark (sort-merge, hot keys split at run time).
    df = _attach(df, mart["dim_employee"], "employee_id", _EMPLOYEE, wanted)
    df = _attach(df, mart["dim_departments"], "department_id", _DEPARTMENT, wanted)
    df = _attach(df, mart["dim_company"], "company_id", _COMPANY, wanted)
    return conform(df.selectExpr("*", f"'{PAYROLL}' AS source_fact"), CUBE, wanted)


def payroll_branch_bucketed(
    mart: Layer, fact: Bucketed, employees: Bucketed, columns: Iterable[str] | None = None
) -> DataFrame:
    """``payroll_branch`` from payroll and workforce stored by employee, in the same number of buckets.

    The employee join of the bucketed rows reads matching buckets, without a shuffle. Rows of hot employees join only the
    workforce rows of those few; they are broadcast if measured small, which unique keys make them.
    """
    parts = [(fact.cold, employees.cold)]
    if fact.hot is not None:
        few = employees.cold.filter(is_hot(fact.key, fact.hot_keys))
        parts.append((fact.hot, F.broadcast(few) if is_small(few) else few))
    branches = []
    for rows, people in parts:
        tables = {name: lambda name=name: mart[name] for name in mart if name != "dim_employee"}
        branches.append(payroll_branch(Layer({**tables, "dim_employee": lambda people=people: people}), columns, rows))
    return reduce(DataFrame.unionByName, branches)


def gl_branch(mart: Layer, columns: Iterable[str] | None = None, fact: DataFrame | None = None) -> DataFrame:
    """Ledger rows with their account, department and company; payroll columns are typed NULLs."""
    wanted = _wanted(columns)
    df = (mart["fact_gl"] if fact is None else fact).withColumnsRenamed(
        {"gl_id": "transaction_id", "posting_date": "transaction_date"}
    )
    # the layer's verdict on the whole dimension, the one its ledger fact was joined with
    small = bool(wanted & set(_ACCOUNT)) and mart.is_small("dim_account")
    df = _attach(df, mart["dim_account"], "account_id", _ACCOUNT, wanted, small)
    df = _attach(df, mart["dim_departments"], "department_id", _DEPARTMENT, wanted)
    df = _attach(df, mart["dim_company"], "company_id", _COMPANY, wanted)
    return conform(df.selectExpr("*", f"'{GENERAL_LEDGER}' AS source_fact"), CUBE, wanted)


def integrated_cube(mart: Layer, columns: Iterable[str] | None = None) -> DataFrame:
    """Both branches, every row of each."""
    return payroll_branch(mart, columns).unionByName(gl_branch(mart, columns))


PROFILE_COLUMNS = ("source_fact", "company_id", "department_id", "transaction_date")


def profile(cube: DataFrame) -> DataFrame:
    """Rows, companies, departments and date span per source.

    Two distinct counts over the facts would triple every row before the shuffle; counting over the company x
    department groups instead needs one aggregate of the facts and one of a few hundred rows.
    """
    groups = cube.groupBy("source_fact", "company_id", "department_id").agg(
        *named(n="count(*)", first_day="min(transaction_date)", last_day="max(transaction_date)")
    )
    return (
        groups.groupBy("source_fact")
        .agg(
            *named(
                total_records="sum(n)",
                unique_companies="count(DISTINCT company_id)",
                unique_departments="count(DISTINCT department_id)",
                earliest_transaction="min(first_day)",
                latest_transaction="max(last_day)",
            )
        )
        .orderBy("source_fact")
    )


_SAMPLE_COLUMNS = (
    "source_fact",
    "transaction_id",
    "transaction_date",
    "fiscal_year",
    "fiscal_period",
    "company_name",
    "department_name",
    "employee_name",
    "account_name",
    "status",
)
_SAMPLE_AMOUNTS = ("total_compensation", "net_amount")


def sample(mart: Layer, n: int = 10) -> DataFrame:
    """The first ``n`` cube rows by source and transaction, with one amount column.

    The order uses fact columns only and the dimension joins keep every row, so each fact is cut to its first
    ``n`` rows before joining. Rows equal in all the order columns give equal output rows.
    """
    gl = mart["fact_gl"]
    gl = gl.orderBy(
        "gl_id", "posting_date", "account_id", "company_id", "department_id", "net_amount", "status",
        "fiscal_year", "fiscal_period",
    ).limit(n)
    pay = mart["fact_payroll"]
    pay = pay.orderBy(
        "payroll_id", "pay_date", "employee_id", "company_id", "department_id", "total_compensation", "status"
    ).limit(n)
    needed = (*_SAMPLE_COLUMNS, *_SAMPLE_AMOUNTS)
    both = gl_branch(mart, needed, gl).unionByName(payroll_branch(mart, needed, pay))
    return (
        both.withColumn("amount", F.coalesce(*_SAMPLE_AMOUNTS))
        .select(*_SAMPLE_COLUMNS[:-1], "amount", "status")
        .orderBy(
            "source_fact", "transaction_id", "transaction_date", "account_name", "company_name", "department_name",
            "employee_name", "amount", "status",
        )
        .limit(n)
    )
