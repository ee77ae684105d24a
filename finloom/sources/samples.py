"""Raw layer derived from the sample tables (region, nation, customer, part, orders, lineitem).

Every raw table comes from one sample table, all columns are text, and the data keeps the defects the clean
layer has to handle: repeated ledger keys, unparsable dates, NULL parts, orphan accounts and departments.
The mapping is described in FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from finloom.functions.columns import RAW_DATE_FORMAT
from finloom.functions.money import money
from finloom.layer import Layer
from finloom.schemas import MANIFEST, RAW


def _text(expression: str) -> str:
    return f"CAST({expression} AS STRING)"


def _date(expression: str, pattern: str = RAW_DATE_FORMAT) -> str:
    return f"date_format({expression}, '{pattern}')"


def accounts(part: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Parts folded onto 640 account numbers; some numbers are left out, so ledger lines point nowhere."""
    folded = (
        part.selectExpr("(p_partkey * 37) % 640 AS slot", "p_name", "p_type", "p_brand")
        .filter("slot % 50 <> 7")
        .groupBy("slot")
        .agg({"p_name": "min", "p_type": "min", "p_brand": "min"})
        .withColumnRenamed("min(p_name)", "account_name")
        .withColumnRenamed("min(p_type)", "account_type")
        .withColumnRenamed("min(p_brand)", "category")
    )
    return folded, {
        "account_id": _text("1000 + 10 * slot"),
        "account_code": "concat('ACC-', 1000 + 10 * slot)",
        "is_active": "'TRUE'",
    }


def company(region: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    return region, {
        "company_id": _text("r_regionkey + 1"),
        "company_name": "r_name",
        "industry": "'Technology'",
        "country": "concat('C', r_regionkey)",
        "established_date": "concat('15-03-20', r_regionkey + 10)",
        "is_active": "'TRUE'",
    }


def departments(nation: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    return nation.filter("n_nationkey <> 24"), {
        "department_id": _text("n_nationkey + 1"),
        "department_code": f"concat('DEPT-', lpad({_text('n_nationkey + 1')}, 3, '0'))",
        "department_name": "n_name",
        "cost_center": "concat('CC-', n_nationkey + 1001)",
    }


def employee(customer: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    hired = _date("date_add(DATE'2015-01-01', CAST(c_custkey % 3000 AS INT))")
    left = _date("date_add(DATE'2016-02-01', CAST(c_custkey % 3000 AS INT))")
    return customer, {
        "employee_id": _text("c_custkey"),
        "employee_code": "concat('EMP-', c_custkey)",
        "first_name": "CASE WHEN c_custkey % 97 <> 0 THEN c_mktsegment END",
        "last_name": "c_name",
        "email": "concat('e', c_custkey, '@example.com')",
        "department_id": _text("c_nationkey + 1"),
        "company_id": _text("c_custkey % 5 + 1"),
        "position": (
            "CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'Junior' "
            "WHEN c_mktsegment = 'BUILDING' THEN 'Senior' WHEN c_mktsegment = 'FURNITURE' THEN 'Manager' "
            "WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Director' END"
        ),
        "hire_date": hired,
        "termination_date": f"CASE WHEN c_acctbal < 0 THEN {left} END",
        "base_salary": _text(money("c_acctbal")),
        "is_active": "CASE WHEN c_acctbal >= 0 THEN 'TRUE' ELSE 'FALSE' END",
    }


def general_ledgers(lineitem: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    price = _text(money("l_extendedprice"))
    return lineitem, {
        "gl_id": f"CASE WHEN l_orderkey % 400 = 7 THEN 'n/a' ELSE {_text('l_orderkey * 10 + l_linenumber')} END",
        "entry_date": _date("date_sub(l_shipdate, l_linenumber)"),
        "posting_date": (
            f"CASE WHEN l_linenumber = 7 THEN {_date('l_shipdate', 'dd-MM-yyyy')} ELSE {_date('l_shipdate')} END"
        ),
        "fiscal_year": _text("year(l_shipdate)"),
        "fiscal_period": _text("month(l_shipdate)"),
        "company_id": _text("l_suppkey % 5 + 1"),
        "account_id": _text("1000 + 10 * ((l_partkey * 37) % 640)"),
        "department_id": _text("l_orderkey % 25 + 1"),
        "transaction_type": "CASE WHEN l_linestatus = 'F' THEN 'Debit' ELSE 'Credit' END",
        "debit_amount": f"CASE WHEN l_linestatus = 'F' THEN {price} ELSE '0.00' END",
        "credit_amount": f"CASE WHEN l_linestatus = 'F' THEN '0.00' ELSE {price} END",
        "reference_number": "concat('REF-', l_orderkey)",
        "description": "concat('Shipment line ', l_linenumber)",
        "status": "CASE WHEN l_returnflag = 'R' THEN 'Draft' ELSE 'Posted' END",
        "created_by": "concat('user', l_suppkey % 10)",
        "approved_by": "CASE WHEN l_returnflag <> 'R' THEN concat('mgr', l_suppkey % 3) END",
    }


def payroll(orders: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    paid = _date("o_orderdate")

    def share(rate: str) -> str:
        return _text(money(f"{money('o_totalprice')} * {rate}"))

    return orders, {
        "payroll_id": f"CASE WHEN o_orderkey % 400 = 7 THEN 'n/a' ELSE {_text('o_orderkey')} END",
        "employee_id": _text("o_custkey"),
        "company_id": _text("o_custkey % 5 + 1"),
        "department_id": _text("(o_custkey div 5) % 25 + 1"),
        "pay_period_start": paid,
        "pay_period_end": paid,
        "pay_date": paid,
        "gross_salary": share("1.00"),
        "bonus": share("0.10"),
        "overtime_pay": f"CASE WHEN o_orderpriority = '1-URGENT' THEN {share('0.07')} ELSE '0.00' END",
        "commission": f"CASE WHEN o_orderpriority <> '5-LOW' THEN {share('0.03')} END",
        "allowances": share("0.02"),
        "tax_deduction": share("0.20"),
        "social_security": share("0.06"),
        "health_insurance": share("0.01"),
        "retirement_contribution": share("0.05"),
        "other_deductions": "'0.00'",
        "net_salary": share("0.68"),
        "payment_method": "'Bank'",
        "status": (
            "CASE o_orderstatus WHEN 'F' THEN 'Paid' WHEN 'O' THEN 'Pending' ELSE 'Processed' END"
        ),
    }


_SOURCES = {
    "accounts": ("part", accounts),
    "company": ("region", company),
    "departments": ("nation", departments),
    "employee": ("customer", employee),
    "general_ledgers": ("lineitem", general_ledgers),
    "payroll": ("orders", payroll),
}


def raw_layer(spark: SparkSession, folder: str) -> Layer:
    """The six raw tables over the sample tables in ``folder``; nothing is read until a table is asked for."""

    def table(name: str) -> DataFrame:
        sample, mapping = _SOURCES[name]
        rows, texts = mapping(spark.read.parquet(f"{folder}/{sample}.parquet"))
        return rows.selectExpr(*(f"{texts.get(c, c)} AS {c}" for c in RAW[name].names))

    return Layer({name: lambda name=name: table(name) for name in _SOURCES})


def manifest(spark: SparkSession) -> DataFrame:
    """The control rows for the six raw tables."""
    return spark.createDataFrame([(name, "raw", name) for name in _SOURCES], MANIFEST)
