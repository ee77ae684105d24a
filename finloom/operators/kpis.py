"""The ten KPIs, each defined once.

The ledger KPIs read a monthly rollup (month x company x section x category) instead of ledger lines. Sums of
sums are exact in decimal, so the rollup can be stored once and shared; composed lazily it adds one shuffle of
pre-aggregated rows and takes two sums per ledger line, however many a KPI needs. Dimensions are joined after
aggregating: their keys are unique (see the key check in ``quality``), and the rows left to join are few whatever
the facts hold.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finloom.functions.columns import fiscal_month_label, named
from finloom.functions.money import amount, percentage, quotient, total
from finloom.layer import Layer
from finloom.operators.mart import POSTED
from finloom.schemas import MART

MONTH = ("fiscal_year", "fiscal_period")
LABEL = f"{fiscal_month_label(*MONTH)} AS fiscal_month_label"
ROLLUP = "gl_monthly"


def gl_monthly(fact_gl: DataFrame) -> DataFrame:
    """Posted debits and credits per month, company, section and category.

    The month label is a function of year and period, so it is left out of the keys and put back on the KPI
    rows: the scan reads one text column less and the facts are hashed on fewer bytes.
    """
    return (
        fact_gl.filter(f"status = '{POSTED}'")
        .groupBy(*MONTH, "company_id", "pl_section", "opex_category")
        .agg(*named(debits=total("debit_amount"), credits=total("credit_amount")))
    )


def _rollup(mart: Layer, *sections: str) -> DataFrame:
    """The monthly rollup, stored or not, of the given sections or of all."""
    monthly = mart[ROLLUP] if ROLLUP in mart else gl_monthly(mart["fact_gl"])
    wanted = ", ".join(f"'{section}'" for section in sections)
    return monthly.filter(f"pl_section IN ({wanted})") if sections else monthly


def _in_section(section: str, side: str) -> str:
    """Sum of one section's side, 0 where the group has none of it."""
    return total(f"CASE WHEN pl_section = '{section}' THEN {side} ELSE 0 END")


def _with_company(df: DataFrame, mart: Layer) -> DataFrame:
    """Add the company name; rows of an unknown company drop out."""
    return df.join(mart["dim_company"].select("company_id", "company_name"), "company_id")


def _with_department(df: DataFrame, mart: Layer, *attributes: str) -> DataFrame:
    return df.join(mart["dim_departments"].select("department_id", "department_name", *attributes), "department_id")


def monthly_consolidated_revenue(mart: Layer) -> DataFrame:
    monthly = _rollup(mart, "Revenue").groupBy(*MONTH).agg(*named(total_revenue=total("credits")))
    # One row per month: the window's single partition holds twelve rows a year, at any data size.
    before = "lag(total_revenue) OVER (ORDER BY fiscal_year, fiscal_period)"
    return (
        monthly.selectExpr("*", f"{before} AS prev_month_revenue")
        .selectExpr(
            *MONTH,
            LABEL,
            "total_revenue",
            "prev_month_revenue",
            f"{percentage('total_revenue - prev_month_revenue', 'prev_month_revenue')} AS mom_growth_pct",
        )
        .orderBy("fiscal_year", "fiscal_period")
    )


def cost_of_sales_by_month(mart: Layer) -> DataFrame:
    costs = _rollup(mart, "COGS").groupBy(*MONTH, "company_id").agg(*named(cost_of_sales=total("debits")))
    return (
        _with_company(costs, mart)
        .selectExpr(*MONTH, LABEL, "company_id", "company_name", "cost_of_sales")
        .orderBy("fiscal_year", "fiscal_period", "company_id")
    )


def gross_profit_margin(mart: Layer) -> DataFrame:
    sums = (
        _rollup(mart, "Revenue", "COGS")
        .groupBy(*MONTH, "company_id")
        .agg(*named(revenue=_in_section("Revenue", "credits"), cogs=_in_section("COGS", "debits")))
    )
    return (
        _with_company(sums, mart)
        .selectExpr(
            *MONTH,
            LABEL,
            "company_id",
            "company_name",
            "revenue",
            "cogs",
            f"{amount('revenue - cogs')} AS gross_profit",
            f"{percentage('revenue - cogs', 'revenue')} AS gross_profit_margin_pct",
        )
        .orderBy("fiscal_year", "fiscal_period", "company_id")
    )


def opex_breakdown(mart: Layer) -> DataFrame:
    costs = (
        _rollup(mart, "Operating Expense")
        .groupBy(*MONTH, "company_id", F.expr("coalesce(opex_category, 'Other') AS opex_category"))
        .agg(*named(opex_amount=total("debits")))
    )
    return (
        _with_company(costs, mart)
        .selectExpr(*MONTH, LABEL, "company_id", "company_name", "opex_category", "opex_amount")
        .orderBy("fiscal_year", "fiscal_period", "company_id", F.desc("opex_amount"), "opex_category")
    )


# Output column of each average, and the pay part it is taken of.
_AVERAGES = {
    "avg_total_compensation": "total_compensation",
    "avg_gross_salary": "gross_salary",
    "avg_bonus": "bonus",
    "avg_overtime": "overtime_pay",
    "avg_commission": "commission",
    "avg_allowances": "allowances",
}


def avg_compensation_by_position(mart: Layer) -> DataFrame:
    """Company of the payroll row, position of the employee.

    Payroll is first reduced to one row per company and employee, sums and counts of known amounts kept
    apart. The join with the workforce then moves one row per employee, so an employee with a large share of
    the payroll rows weighs no more than any other.
    """
    parts = _AVERAGES.values()
    sums = {f"{p}_sum": total(p) for p in parts}
    counts = {f"{p}_n": f"count({p})" for p in parts}
    per_employee = mart["fact_payroll"].groupBy("company_id", "employee_id").agg(*named(**sums, **counts))
    averages = {name: quotient(f"sum({part}_sum)", f"sum({part}_n)") for name, part in _AVERAGES.items()}
    by_position = (
        per_employee.join(mart["dim_employee"].select("employee_id", "position"), "employee_id")
        .groupBy("company_id", "position")
        .agg(*named(employee_count="count(DISTINCT employee_id)", **averages))
    )
    return (
        _with_company(by_position, mart)
        .select("company_id", "company_name", "position", "employee_count", *_AVERAGES)
        .orderBy("company_id", "position")
    )


def net_profit_by_month(mart: Layer) -> DataFrame:
    sums = (
        _rollup(mart)
        .groupBy(*MONTH, "company_id")
        .agg(
            *named(
                revenue=_in_section("Revenue", "credits"),
                cogs=_in_section("COGS", "debits"),
                operating_expenses=_in_section("Operating Expense", "debits"),
                tax_expense=_in_section("Tax", "debits"),
            )
        )
    )
    ebit = "revenue - cogs - operating_expenses"
    return (
        _with_company(sums, mart)
        .selectExpr(
            *MONTH,
            LABEL,
            "company_id",
            "company_name",
            "revenue",
            "cogs",
            f"{amount('revenue - cogs')} AS gross_profit",
            "operating_expenses",
            f"{amount(ebit)} AS ebit",
            "tax_expense",
            f"{amount(f'{ebit} - tax_expense')} AS net_profit",
            f"{percentage(f'{ebit} - tax_expense', 'revenue')} AS net_profit_margin_pct",
        )
        .orderBy("fiscal_year", "fiscal_period", "company_id")
    )


def net_profit_of(mart: Layer, companies: str) -> DataFrame:
    """Net profit by month of the companies that fulfil a condition on their dimension.

    The ledger is narrowed to them before anything is summed. Over the stored fact, partitioned by company, Spark finds
    their keys first and reads only their partitions.
    """
    wanted = mart["dim_company"].filter(companies)
    lines = mart["fact_gl"].join(wanted.select("company_id"), "company_id", "left_semi")
    parts = {"dim_company": lambda: wanted, "fact_gl": lambda: lines}
    return net_profit_by_month(Layer({name: parts.get(name, lambda name=name: mart[name]) for name in MART}))


def _payroll_by_department(mart: Layer, **sums: str) -> DataFrame:
    """Payroll totals and exact headcount per company and department.

    The distinct count is planned in two steps, the first keyed by employee as well, so a department with a
    third of all rows is spread over many tasks.
    """
    totals = {name: total(part) for name, part in sums.items()}
    return (
        mart["fact_payroll"]
        .groupBy("company_id", "department_id")
        .agg(*named(**totals, employee_count="count(DISTINCT employee_id)"))
    )


def overtime_bonus_analysis(mart: Layer) -> DataFrame:
    sums = _payroll_by_department(
        mart,
        total_overtime_pay="overtime_pay",
        total_bonus="bonus",
        total_gross_salary="gross_salary",
        total_commission="commission",
    )
    return (
        _with_company(_with_department(sums, mart), mart)
        .selectExpr(
            "company_id",
            "company_name",
            "department_id",
            "department_name",
            "total_overtime_pay",
            "total_bonus",
            "total_gross_salary",
            "total_commission",
            f"{percentage('total_overtime_pay', 'total_gross_salary')} AS overtime_to_base_ratio_pct",
            f"{percentage('total_bonus', 'total_gross_salary')} AS bonus_to_base_ratio_pct",
            "employee_count",
        )
        .orderBy("company_id", F.desc("total_overtime_pay"), "department_id")
    )


def cost_per_department(mart: Layer) -> DataFrame:
    parts = {
        "total_compensation_cost": "total_compensation",
        "total_gross_salary": "gross_salary",
        "total_bonus": "bonus",
        "total_overtime": "overtime_pay",
        "total_commission": "commission",
        "total_allowances": "allowances",
    }
    sums = _payroll_by_department(mart, **parts)
    return (
        _with_company(_with_department(sums, mart, "cost_center"), mart)
        .selectExpr(
            "company_id",
            "company_name",
            "department_id",
            "department_name",
            "cost_center",
            *parts,
            "employee_count",
            f"{quotient('total_compensation_cost', 'employee_count')} AS cost_per_employee",
        )
        .orderBy("company_id", F.desc("total_compensation_cost"), "department_id")
    )


def headcount_by_department(mart: Layer) -> DataFrame:
    counts = (
        mart["dim_employee"]
        .filter("is_active")
        .groupBy("company_id", "department_id")
        .agg(
            *named(
                active_headcount="count(*)",
                junior_count="count_if(position = 'Junior')",
                senior_count="count_if(position = 'Senior')",
                manager_count="count_if(position = 'Manager')",
                avg_base_salary=quotient("sum(base_salary)", "count(base_salary)"),
                total_annual_base_cost=total("base_salary"),
            )
        )
    )
    return (
        _with_company(_with_department(counts, mart, "cost_center"), mart)
        .select(
            "company_id",
            "company_name",
            "department_id",
            "department_name",
            "cost_center",
            "active_headcount",
            "junior_count",
            "senior_count",
            "manager_count",
            "avg_base_salary",
            "total_annual_base_cost",
        )
        .orderBy("company_id", F.desc("active_headcount"), "department_id")
    )


def payroll_cost_pct_revenue(mart: Layer) -> DataFrame:
    """Months with both revenue and payroll in a company; others drop out."""
    revenue = _rollup(mart, "Revenue").groupBy(*MONTH, "company_id").agg(*named(total_revenue=total("credits")))
    pay = (
        mart["fact_payroll"]
        .groupBy("fiscal_year", "fiscal_period", "company_id")
        .agg(*named(total_payroll_cost=total("total_compensation"), headcount="count(DISTINCT employee_id)"))
    )
    both = revenue.join(pay, ["fiscal_year", "fiscal_period", "company_id"])
    return (
        _with_company(both, mart)
        .selectExpr(
            *MONTH,
            LABEL,
            "company_id",
            "company_name",
            "total_revenue",
            "total_payroll_cost",
            "headcount",
            f"{percentage('total_payroll_cost', 'total_revenue')} AS payroll_pct_of_revenue",
            f"{quotient('total_revenue', 'headcount')} AS revenue_per_employee",
        )
        .orderBy("fiscal_year", "fiscal_period", "company_id")
    )


class Kpi(NamedTuple):
    view: str
    build: Callable[[Layer], DataFrame]
    of_ledger: bool = True


# Table and view name of each KPI.
KPIS: dict[str, Kpi] = {
    "kpi1_monthly_consolidated_revenue": Kpi("vw_monthly_consolidated_revenue", monthly_consolidated_revenue),
    "kpi2_cost_of_sales_by_month": Kpi("vw_cost_of_sales_by_month", cost_of_sales_by_month),
    "kpi3_gross_profit_margin": Kpi("vw_gross_profit_margin", gross_profit_margin),
    "kpi4_opex_breakdown": Kpi("vw_opex_breakdown", opex_breakdown),
    "kpi5_avg_compensation_by_position": Kpi(
        "vw_avg_compensation_by_position", avg_compensation_by_position, of_ledger=False
    ),
    "kpi6_net_profit_by_month": Kpi("vw_net_profit_by_month", net_profit_by_month),
    "kpi7_overtime_bonus_analysis": Kpi("vw_overtime_bonus_analysis", overtime_bonus_analysis, of_ledger=False),
    "kpi8_cost_per_department": Kpi("vw_cost_per_department", cost_per_department, of_ledger=False),
    "kpi9_headcount_by_department": Kpi("vw_headcount_by_department", headcount_by_department, of_ledger=False),
    "kpi10_payroll_cost_pct_revenue": Kpi("vw_payroll_cost_pct_revenue", payroll_cost_pct_revenue),
}


def first_months(kpi: DataFrame, n: int = 5) -> DataFrame:
    """The first rows of a monthly KPI; the company breaks ties between rows of one month."""
    order = [c for c in ("fiscal_year", "fiscal_period", "company_id") if c in kpi.columns]
    return kpi.orderBy(*order).limit(n)


# Columns that name a KPI's row; the others are its measures.
ROW_COLUMNS = (
    "fiscal_year",
    "fiscal_period",
    "fiscal_month_label",
    "company_id",
    "company_name",
    "department_id",
    "department_name",
    "cost_center",
    "position",
    "opex_category",
)


def long_form(kpi: DataFrame, name: str) -> DataFrame:
    """A KPI with one row per measure: kpi, row_key, measure, value (text of decimal(28,2))."""
    keys = ", ".join(f"coalesce(CAST({c} AS STRING), '')" for c in kpi.columns if c in ROW_COLUMNS)
    measures = [c for c in kpi.columns if c not in ROW_COLUMNS]
    pairs = ", ".join(f"'{c}', CAST({amount(c)} AS STRING)" for c in measures)
    return kpi.selectExpr(
        f"'{name}' AS kpi", f"concat_ws('|', {keys}) AS row_key", f"stack({len(measures)}, {pairs}) AS (measure, value)"
    )
