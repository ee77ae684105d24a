"""Declared schema of every table, layer by layer.

Surrogate keys of the facts and of the workforce are bigint: ledger line numbers pass 2^31 long before
100 TB. Money is decimal(18,2) from the clean layer on, and decimal(28,2) once summed.
"""

from __future__ import annotations

from pyspark.sql import types as T

INT = T.IntegerType()
LONG = T.LongType()
TEXT = T.StringType()
DATE = T.DateType()
FLAG = T.BooleanType()
MONEY = T.DecimalType(18, 2)
TOTAL = T.DecimalType(28, 2)

# Table and column names of the data model.

_PAY_PARTS = ("gross_salary", "bonus", "overtime_pay", "commission", "allowances")
_DEDUCTIONS = (
    "tax_deduction",
    "social_security",
    "health_insurance",
    "retirement_contribution",
    "other_deductions",
)

_TYPES: dict[str, T.DataType] = {
    "account_id": INT,
    "company_id": INT,
    "department_id": INT,
    "fiscal_year": INT,
    "fiscal_period": INT,
    "employee_id": LONG,
    "gl_id": LONG,
    "payroll_id": LONG,
    "transaction_id": LONG,
    "is_active": FLAG,
    "employee_is_active": FLAG,
    "company_is_active": FLAG,
    **dict.fromkeys(
        (
            "hire_date",
            "termination_date",
            "entry_date",
            "posting_date",
            "pay_period_start",
            "pay_period_end",
            "pay_date",
            "transaction_date",
        ),
        DATE,
    ),
    **dict.fromkeys(
        (
            *_PAY_PARTS,
            *_DEDUCTIONS,
            "total_compensation",
            "total_deductions",
            "net_salary",
            "base_salary",
            "employee_base_salary",
            "debit_amount",
            "credit_amount",
            "net_amount",
        ),
        MONEY,
    ),
}


def _struct(names: str, **overrides: T.DataType) -> T.StructType:
    """Columns by name; a name not listed in ``_TYPES`` is text."""
    types = {**_TYPES, **overrides}
    return T.StructType([T.StructField(n, types.get(n, TEXT)) for n in names.split()])


def all_text(schema: T.StructType) -> T.StructType:
    """The raw form of a table: same columns, every one a string."""
    return T.StructType([T.StructField(n, TEXT) for n in schema.names])


CLEAN: dict[str, T.StructType] = {
    "accounts": _struct("account_id account_code account_name account_type category is_active"),
    "company": _struct("company_id company_name industry country established_date is_active"),
    "departments": _struct("department_id department_code department_name cost_center"),
    "employee": _struct(
        "employee_id employee_code first_name last_name email department_id company_id position "
        "hire_date termination_date base_salary is_active"
    ),
    "general_ledgers": _struct(
        "gl_id entry_date posting_date fiscal_year fiscal_period company_id account_id department_id "
        "transaction_type debit_amount credit_amount reference_number description status created_by approved_by"
    ),
    "payroll": _struct(
        "payroll_id employee_id company_id department_id pay_period_start pay_period_end pay_date "
        "gross_salary bonus overtime_pay commission allowances tax_deduction social_security health_insurance "
        "retirement_contribution other_deductions net_salary payment_method status"
    ),
}

RAW: dict[str, T.StructType] = {name: all_text(schema) for name, schema in CLEAN.items()}

MANIFEST = all_text(_struct("file_name sink_schema table_name"))

SILVER: dict[str, T.StructType] = {
    "accounts": _struct("account_id account_name account_type category is_active"),
    "company": CLEAN["company"],
    "departments": _struct("department_id department_name cost_center"),
    "employee": _struct(
        "employee_id email department_id company_id position hire_date termination_date base_salary "
        "is_active FullName"
    ),
    "general_ledgers": _struct(
        "gl_id entry_date posting_date fiscal_year fiscal_period company_id account_id department_id "
        "transaction_type debit_amount credit_amount status created_by approved_by net_amount fiscal_month_label"
    ),
    "payroll": _struct(
        "payroll_id employee_id company_id department_id pay_period_start pay_period_end pay_date "
        "gross_salary bonus overtime_pay commission allowances tax_deduction social_security health_insurance "
        "retirement_contribution other_deductions net_salary status total_compensation total_deductions "
        "fiscal_year fiscal_period fiscal_month_label"
    ),
}

MART: dict[str, T.StructType] = {
    "dim_account": _struct("account_id account_name account_type category is_active pl_section opex_category"),
    "dim_departments": _struct("department_id department_name cost_center"),
    "dim_employee": _struct(
        "employee_id FullName email department_id company_id position hire_date termination_date "
        "base_salary is_active"
    ),
    "dim_company": _struct("company_id company_name industry country established_date is_active"),
    "fact_gl": _struct(
        "gl_id entry_date posting_date fiscal_year fiscal_period fiscal_month_label company_id account_id "
        "department_id transaction_type debit_amount credit_amount net_amount pl_section opex_category "
        "account_type account_name status created_by approved_by"
    ),
    "fact_payroll": _struct(
        "payroll_id employee_id company_id department_id pay_period_start pay_period_end pay_date fiscal_year "
        "fiscal_period fiscal_month_label gross_salary bonus overtime_pay commission allowances "
        "total_compensation tax_deduction social_security health_insurance retirement_contribution "
        "other_deductions total_deductions net_salary status"
    ),
}

# account_id is text in the cube: payroll rows carry an untyped-by-nature NULL there and reporting tools read
# the column as a code, not as a number.
CUBE: T.StructType = _struct(
    "source_fact transaction_id transaction_date pay_period_start pay_period_end fiscal_year fiscal_period "
    "fiscal_month_label employee_id employee_name employee_email employee_position hire_date termination_date "
    "employee_base_salary employee_is_active department_id department_name cost_center company_id company_name "
    "industry country company_established_date company_is_active account_id account_name account_type "
    "account_category gross_salary bonus overtime_pay commission allowances total_compensation tax_deduction "
    "social_security health_insurance retirement_contribution other_deductions total_deductions net_salary "
    "debit_amount credit_amount net_amount transaction_type pl_section opex_category status created_by "
    "approved_by",
    account_id=TEXT,
)

KEYS: dict[str, str] = {
    "accounts": "account_id",
    "company": "company_id",
    "departments": "department_id",
    "employee": "employee_id",
    "general_ledgers": "gl_id",
    "payroll": "payroll_id",
}

PAY_PARTS = _PAY_PARTS
DEDUCTIONS = _DEDUCTIONS
