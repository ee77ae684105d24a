"""Hand-written rows for the semantics the layers have to keep."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from finloom.functions.columns import as_type, fiscal_month_label, lenient_date
from finloom.functions.money import percentage, quotient
from finloom.layer import Layer
from finloom.operators import cube, quality, silver
from finloom.sources.samples import raw_layer
from finloom.plans.pipeline import check_dimension_keys
from finloom.operators.clean import (
    LATEST_BY,
    clean_table,
    dedup,
    kept,
    null_policy,
    parse_dates,
    rejected,
    rejects,
    typed,
)
from finloom.operators.kpis import KPIS, first_months
from finloom.operators.mart import dim_account, fact_gl
from finloom.schemas import CLEAN, MART, RAW, SILVER

D = Decimal
DAY = datetime.date(2024, 1, 15)


def rows_of(spark, schema, *rows):
    """Rows from dictionaries; a column that is not given is NULL."""
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)


def values(spark, column_type, items, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, x {column_type}")
    return [r[0] for r in df.orderBy("i").selectExpr(expression).collect()]


# --- scalar rules --------------------------------------------------------------------------------------------


def test_date_texts(spark):
    texts = [
        "15-03-2010 09:30",
        "15-03-2010",
        "5-3-2010 09:30",
        "31-02-2010 09:30",
        "15-03-2010 24:30",
        "15-03-2010 9:30",
        "2010-03-15 09:30",
        "15-03-2010 09:30:00",
        " 15-03-2010 09:30",
        "",
        None,
    ]
    parsed = values(spark, "string", texts, lenient_date("x"))
    assert parsed == [datetime.date(2010, 3, 15)] + [None] * 10


def test_length_guard_changes_nothing(spark):
    days, months, years, times = ("1", "07", "31"), ("2", "12"), ("10", "2010"), ("", "1:5", "09:30")
    texts = [f"{d}-{m}-{y} {t}" for d in days for m in months for y in years for t in times]
    assert values(spark, "string", texts, lenient_date("x")) == values(
        spark, "string", texts, "try_to_date(x, 'dd-MM-yyyy HH:mm')"
    )


def test_typed_text_that_does_not_fit_is_null(spark):
    assert values(spark, "string", ["12", "x", "", None], as_type("x", T.IntegerType())) == [12, None, None, None]
    money = values(spark, "string", ["1.005", "-2", "abc"], as_type("x", T.DecimalType(18, 2)))
    assert money == [D("1.01"), D("-2.00"), None]
    assert values(spark, "string", ["TRUE", "false", "maybe"], as_type("x", T.BooleanType())) == [True, False, None]


def test_month_label(spark):
    assert values(spark, "int", [1, 12, 123, None], fiscal_month_label("2025", "x")) == [
        "2025-01",
        "2025-12",
        "2025-12",
        None,
    ]


def test_ratios(spark):
    assert values(spark, "decimal(28,2)", [D(8), D(0), None], percentage("1", "x")) == [D("12.50"), None, None]
    assert values(spark, "decimal(28,2)", [D("16887.85")], quotient("x", "2")) == [D("8443.93")]
    assert values(spark, "decimal(28,2)", [D("-16887.85")], quotient("x", "2")) == [D("-8443.93")]
    # large sums keep their digits
    assert values(spark, "decimal(28,2)", [D("9" * 20)], percentage("x", "x")) == [D("100.00")]


# --- account ranges ------------------------------------------------------------------------------------------

EDGES = {
    3999: ("Balance Sheet", None),
    4000: ("Revenue", None),
    4999: ("Revenue", None),
    5000: ("COGS", None),
    5999: ("COGS", None),
    6000: ("Operating Expense", "Personnel"),
    6099: ("Operating Expense", "Personnel"),
    6100: ("Operating Expense", "Occupancy"),
    6200: ("Operating Expense", "Technology"),
    6300: ("Operating Expense", "Marketing"),
    6400: ("Operating Expense", "Travel & Entertainment"),
    6500: ("Operating Expense", "Professional Fees"),
    6600: ("Operating Expense", "Communications"),
    6700: ("Operating Expense", "Financial Charges"),
    6800: ("Operating Expense", "Depreciation & Amortisation"),
    6900: ("Operating Expense", "Other Operating"),
    7000: ("Operating Expense", "R&D"),
    7099: ("Operating Expense", "R&D"),
    7100: ("Tax", None),
    7199: ("Tax", None),
    7200: ("Balance Sheet", None),
    None: ("Balance Sheet", None),
}


def test_account_ranges(spark):
    accounts = rows_of(spark, SILVER["accounts"], *({"account_id": a} for a in EDGES))
    found = {r["account_id"]: (r["pl_section"], r["opex_category"]) for r in dim_account(accounts).collect()}
    assert found == EDGES


def test_orphan_account_is_not_balance_sheet(spark):
    accounts = dim_account(rows_of(spark, SILVER["accounts"], {"account_id": 4000}, {"account_id": None}))
    lines = rows_of(
        spark,
        SILVER["general_ledgers"],
        {"gl_id": 1, "account_id": 4000, "status": "Posted"},
        {"gl_id": 2, "account_id": 4010, "status": "Posted"},
        {"gl_id": 3, "account_id": None, "status": "Posted"},
        {"gl_id": 4, "account_id": 4000, "status": "Draft"},
        {"gl_id": 5, "account_id": 4000, "status": None},
    )
    found = {r["gl_id"]: r["pl_section"] for r in fact_gl(lines, accounts).collect()}
    assert found == {1: "Revenue", 2: None, 3: None}


# --- clean ---------------------------------------------------------------------------------------------------


def test_parse_dates_leaves_other_columns(spark):
    df = spark.createDataFrame(
        [("1", "15-03-2010 09:30", "x", "100")],
        "employee_id string, hire_date string, termination_date string, base_salary string",
    )
    assert parse_dates(df, CLEAN["employee"]).first().asDict() == {
        "employee_id": "1",
        "hire_date": datetime.date(2010, 3, 15),
        "termination_date": None,
        "base_salary": "100",
    }


def test_company_date_stays_text(spark):
    raw = rows_of(
        spark,
        T.StructType([T.StructField(n, T.StringType()) for n in CLEAN["company"].names]),
        {"company_id": "1", "established_date": "15-03-2010", "is_active": "TRUE"},
    )
    row = typed(raw, CLEAN["company"]).first()
    assert (row["company_id"], row["established_date"], row["is_active"]) == (1, "15-03-2010", True)


def test_null_policy(spark):
    df = spark.createDataFrame([(1, 10, None), (2, None, D(5)), (None, 3, None)], "k int, f int, m decimal(18,2)")
    tagged = null_policy(df, ["k", "f"])
    assert [tuple(r) for r in kept(tagged).collect()] == [(1, 10, None)]
    assert sorted(r["m"] is None for r in rejected(tagged).collect()) == [False, True]
    filled = null_policy(df, ["k"], ["m"])
    assert sorted(r["m"] for r in kept(filled).collect()) == [D(0), D(5)]


def test_dedup_exact_and_by_key(spark):
    rows = [
        (1, DAY, "a"),
        (1, DAY, "a"),
        (1, datetime.date(2024, 2, 1), "b"),
        (1, None, "z"),
        (2, None, "c"),
        (2, None, "b"),
        (None, DAY, "n"),
    ]
    df = spark.createDataFrame(rows, "k int, d date, t string")
    expected = {(1, datetime.date(2024, 2, 1), "b"), (2, None, "b"), (None, DAY, "n")}
    assert {tuple(r) for r in dedup(df, "k", ["d"]).collect()} == expected


def test_one_row_per_key(spark):
    raw = rows_of(
        spark,
        RAW["departments"],
        {"department_id": "1", "department_name": "B"},
        {"department_id": "1", "department_name": "A"},
        {"department_id": "x", "department_name": "C"},
    )
    names = [r["department_name"] for r in clean_table(raw, "departments", one_row_per_key=True).collect()]
    assert names == ["A"]
    assert clean_table(raw, "departments").count() == 3


# --- silver --------------------------------------------------------------------------------------------------


def test_full_name(spark):
    people = rows_of(
        spark,
        CLEAN["employee"],
        {"employee_id": 1, "first_name": "A", "last_name": "B"},
        {"employee_id": 2, "last_name": "B"},
        {"employee_id": 3},
    )
    assert {r["employee_id"]: r["FullName"] for r in silver.employee(people).collect()} == {1: "A B", 2: "B", 3: ""}


def test_missing_part_makes_the_total_null(spark):
    whole = dict.fromkeys(("gross_salary", "bonus", "overtime_pay", "commission", "allowances"), D(1))
    cut = dict.fromkeys(
        ("tax_deduction", "social_security", "health_insurance", "retirement_contribution", "other_deductions"), D(2)
    )
    pay = rows_of(
        spark,
        CLEAN["payroll"],
        {"payroll_id": 1, "pay_date": DAY, **whole, **cut},
        {"payroll_id": 2, **whole, **cut, "commission": None, "social_security": None},
    )
    one, two = silver.payroll(pay).orderBy("payroll_id").collect()
    assert (one["total_compensation"], one["total_deductions"]) == (D(5), D(10))
    assert (one["fiscal_year"], one["fiscal_period"], one["fiscal_month_label"]) == (2024, 1, "2024-01")
    assert (two["total_compensation"], two["total_deductions"], two["fiscal_month_label"]) == (None, None, None)


def test_net_amount(spark):
    lines = rows_of(
        spark,
        CLEAN["general_ledgers"],
        {"gl_id": 1, "debit_amount": D(3), "credit_amount": D(1)},
        {"gl_id": 2, "debit_amount": D(3)},
    )
    assert [r["net_amount"] for r in silver.general_ledgers(lines).orderBy("gl_id").collect()] == [D(-2), None]


# --- KPIs ----------------------------------------------------------------------------------------------------


def line(section, month, company=1, debit="0", credit="0", year=2024, category=None):
    return {
        "gl_id": 1,
        "fiscal_year": year,
        "fiscal_period": month,
        "company_id": company,
        "pl_section": section,
        "opex_category": category,
        "debit_amount": D(debit),
        "credit_amount": D(credit),
        "status": "Posted",
    }


def star(spark, lines=(), pay=(), people=(), companies=(1, 2), departments=(1, 2)):
    tables = {
        "dim_account": [],
        "dim_company": [{"company_id": c, "company_name": f"C{c}"} for c in companies],
        "dim_departments": [
            {"department_id": d, "department_name": f"D{d}", "cost_center": f"CC{d}"} for d in departments
        ],
        "dim_employee": people,
        "fact_gl": lines,
        "fact_payroll": pay,
    }
    return Layer({n: lambda n=n, rows=rows: rows_of(spark, MART[n], *rows) for n, rows in tables.items()})


def kpi(mart, number):
    name = next(n for n in KPIS if n.startswith(f"kpi{number}_"))
    return [r.asDict() for r in KPIS[name].build(mart).collect()]


def test_growth_compares_with_the_previous_row(spark):
    mart = star(
        spark,
        [
            line("Revenue", 11, credit="100", year=2023),
            line("Revenue", 2, credit="150"),  # December and January are missing
            line("Revenue", 3, credit="0"),
            line("Revenue", 4, company=9, credit="10"),  # unknown companies count in the consolidated sum
            line("Revenue", 4, debit="70"),  # reversals are not netted
            line("COGS", 1, credit="500"),
        ],
    )
    columns = ("fiscal_month_label", "total_revenue", "prev_month_revenue", "mom_growth_pct")
    found = [tuple(r[c] for c in columns) for r in kpi(mart, 1)]
    assert found == [
        ("2023-11", D(100), None, None),
        ("2024-02", D(150), D(100), D(50)),
        ("2024-03", D(0), D(150), D(-100)),
        ("2024-04", D(10), D(0), None),
    ]


def test_unknown_company_drops_out(spark):
    mart = star(spark, [line("COGS", 1, debit="5"), line("COGS", 1, company=9, debit="7")])
    assert [(r["company_id"], r["cost_of_sales"]) for r in kpi(mart, 2)] == [(1, D(5))]


def test_margin_without_revenue_is_null(spark):
    lines = [line("COGS", 1, debit="5"), line("Revenue", 2, credit="8"), line("COGS", 2, debit="2")]
    mart = star(spark, [*lines, line("Tax", 3, debit="1")])
    columns = ("fiscal_period", "revenue", "gross_profit", "gross_profit_margin_pct")
    found = [tuple(r[c] for c in columns) for r in kpi(mart, 3)]
    assert found == [(1, D(0), D(-5), None), (2, D(8), D(6), D(75))]


def test_opex_without_category_is_other(spark):
    mart = star(
        spark,
        [
            line("Operating Expense", 1, debit="5", category="R&D"),
            line("Operating Expense", 1, debit="9"),
            line("Operating Expense", 1, debit="1", category="R&D"),
        ],
    )
    assert [(r["opex_category"], r["opex_amount"]) for r in kpi(mart, 4)] == [("Other", D(9)), ("R&D", D(6))]


def test_net_profit_keeps_months_without_pl_lines(spark):
    mart = star(
        spark,
        [
            line("Balance Sheet", 1, debit="5"),
            line(None, 2, debit="5"),
            line("Revenue", 3, credit="100"),
            line("COGS", 3, debit="30"),
            line("Operating Expense", 3, debit="20"),
            line("Tax", 3, debit="10"),
        ],
    )
    columns = ("fiscal_period", "revenue", "ebit", "net_profit", "net_profit_margin_pct")
    found = [tuple(r[c] for c in columns) for r in kpi(mart, 6)]
    assert found == [(1, D(0), D(0), D(0), None), (2, D(0), D(0), D(0), None), (3, D(100), D(50), D(40), D(40))]


def pay_row(pid, employee, company=1, department=1, month=1, gross="100", total="100", **more):
    return {
        "payroll_id": pid,
        "employee_id": employee,
        "company_id": company,
        "department_id": department,
        "fiscal_year": 2024,
        "fiscal_period": month,
        "gross_salary": None if gross is None else D(gross),
        "total_compensation": None if total is None else D(total),
        "bonus": D(10),
        "overtime_pay": D(5),
        **more,
    }


def test_position_averages_use_payroll_company_and_skip_nulls(spark):
    people = [
        {"employee_id": 1, "position": "Senior", "company_id": 2},
        {"employee_id": 2, "position": "Senior"},
        {"employee_id": 3, "position": None},
    ]
    pay = [
        pay_row(1, 1, total="100"),
        pay_row(2, 1, total=None),
        pay_row(3, 1, total="200"),
        pay_row(4, 2, total="101"),
        pay_row(5, 3, total=None),
        pay_row(6, 99),  # unknown employee
        pay_row(7, 1, company=9),  # unknown company
    ]
    columns = ("company_id", "position", "employee_count", "avg_total_compensation")
    found = [tuple(r[c] for c in columns) for r in kpi(star(spark, pay=pay, people=people), 5)]
    assert found == [(1, None, 1, None), (1, "Senior", 2, D("133.67"))]


def test_department_ratios(spark):
    pay = [pay_row(1, 1, gross="0"), pay_row(2, 2, department=2, gross="200"), pay_row(3, 2, department=9)]
    columns = ("department_id", "overtime_to_base_ratio_pct", "bonus_to_base_ratio_pct")
    found = [tuple(r[c] for c in columns) for r in kpi(star(spark, pay=pay), 7)]
    assert found == [(1, None, None), (2, D("2.50"), D("5.00"))]


def test_cost_per_employee(spark):
    pay = [pay_row(1, 1, total="100"), pay_row(2, 1, total="50"), pay_row(3, 2, total="50")]
    pay.append(pay_row(4, 2, department=2, total=None))
    rows = kpi(star(spark, pay=pay), 8)
    found = {r["department_id"]: (r["employee_count"], r["cost_per_employee"], r["cost_center"]) for r in rows}
    assert found == {1: (2, D(100), "CC1"), 2: (1, None, "CC2")}


def test_headcount_counts_active_only(spark):
    def person(i, position, active, salary):
        home = {"company_id": 1, "department_id": 1}
        return {"employee_id": i, "position": position, "is_active": active, "base_salary": salary, **home}

    people = [
        person(1, "Junior", True, D("10.00")),
        person(2, "Manager", True, D("10.01")),
        person(3, "Senior", False, D(9)),
        person(4, None, True, None),
        person(5, "Senior", None, D(1)),
    ]
    row = kpi(star(spark, people=people), 9)[0]
    assert (row["active_headcount"], row["junior_count"], row["senior_count"], row["manager_count"]) == (3, 1, 0, 1)
    assert (row["avg_base_salary"], row["total_annual_base_cost"]) == (D("10.01"), D("20.01"))


def test_payroll_share_needs_both_sides(spark):
    mart = star(
        spark,
        [line("Revenue", 1, credit="400"), line("Revenue", 2, credit="400"), line("Revenue", 4, credit="0")],
        [pay_row(1, 1, total="100"), pay_row(2, 2, total="20"), pay_row(3, 1, month=3), pay_row(4, 1, month=4)],
    )
    columns = ("fiscal_period", "headcount", "payroll_pct_of_revenue", "revenue_per_employee")
    found = [tuple(r[c] for c in columns) for r in kpi(mart, 10)]
    assert found == [(1, 2, D(30), D(200)), (4, 1, None, D(0))]


def test_first_months_breaks_ties_by_company(spark):
    mart = star(spark, [line("Revenue", m, company=c, credit="1") for m in (2, 1) for c in (2, 1)])
    found = first_months(KPIS["kpi6_net_profit_by_month"].build(mart), 3)
    assert [(r["fiscal_period"], r["company_id"]) for r in found.collect()] == [(1, 1), (1, 2), (2, 1)]


# --- cube ----------------------------------------------------------------------------------------------------


def test_cube_takes_keys_from_dimensions(spark):
    stray = {**line("Revenue", 1, company=9, credit="7"), "department_id": 1, "account_id": 4000}
    mart = star(spark, [stray], [pay_row(1, 99, department=9)])
    rows = {r["source_fact"]: r for r in cube.integrated_cube(mart).collect()}
    ledger, pay = rows[cube.GENERAL_LEDGER], rows[cube.PAYROLL]
    assert (ledger["company_id"], ledger["department_id"], ledger["account_id"]) == (None, 1, None)
    assert (pay["company_id"], pay["department_id"], pay["employee_id"]) == (1, None, None)
    assert (ledger["gross_salary"], pay["debit_amount"]) == (None, None)


def test_cube_keeps_duplicates_and_types(spark):
    mart = star(spark, [line("Revenue", 1), line("Revenue", 1)])
    built = cube.integrated_cube(mart)
    assert built.count() == 2
    assert built.schema.simpleString() == cube.CUBE.simpleString()


def test_cube_column_subset_equals_full(mart):
    wanted = ("source_fact", "transaction_id", "company_name", "account_category")
    subset = cube.integrated_cube(mart, wanted)
    assert set(subset.columns) == set(wanted)
    full = cube.integrated_cube(mart).select(*subset.columns)
    assert subset.exceptAll(full).count() == 0 and full.exceptAll(subset).count() == 0
    with pytest.raises(ValueError):
        cube.payroll_branch(mart, ["no_such_column"])


def test_sample_falls_over_to_payroll(spark):
    mart = star(spark, [line("Revenue", 1)], [pay_row(i, 1) for i in (3, 1, 2)])
    found = [(r["source_fact"], r["transaction_id"]) for r in cube.sample(mart, 3).collect()]
    assert found == [("GENERAL_LEDGER", 1), ("PAYROLL", 1), ("PAYROLL", 2)]


# --- quality -------------------------------------------------------------------------------------------------


def test_null_counts_tell_missing_from_unparsed(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("d", T.DateType())])
    raw = spark.createDataFrame([("1", "15-03-2010"), ("x", ""), (None, None)], "a string, d string")
    rows = quality.null_counts(raw, schema, "t").collect()
    found = {r["column_name"]: (r["n_rows"], r["n_null"], r["n_unparsed"]) for r in rows}
    assert found == {"a": (3, 2, 1), "d": (3, 3, 1)}


def test_orphans_and_duplicates(spark):
    fact = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (None, 3)], "a int, b int")
    dim_a, dim_b = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(1,), (2,)], "b int")
    found = {tuple(r)[1:] for r in quality.orphans(fact, "f", {"a": dim_a, "b": dim_b}).collect()}
    assert found == {("a", "2", 1), ("b", "3", 1)}
    assert {tuple(r) for r in quality.duplicate_keys(fact, "a").collect()} == {(1, 2)}


def test_reconcile_reports_a_gap(spark):
    rows = spark.createDataFrame([(1,), (2,), (None,), (None,), (2,), (2,)], "k int")
    good = quality.reconcile("t", rows, "k", "k = 1", rows.filter("k = 1")).first()
    assert tuple(good) == ("t", 6, 2, 2, 2, 1, 1, True)
    assert quality.reconcile("t", rows, "k", "k = 1", rows.filter("k = 5")).first()["balanced"] is False


def test_rejects_and_kept_rows_are_all_rows(spark, small):
    clean = clean_table(raw_layer(spark, small)["general_ledgers"], "general_ledgers")
    out = rejects(clean, "general_ledgers")
    stays = kept(null_policy(dedup(clean, "gl_id", LATEST_BY["general_ledgers"]), ["gl_id"]))
    assert set(r[0] for r in out.select("reject_reason").distinct().collect()) == {"null_key", "duplicate_key"}
    assert out.drop("reject_reason").unionAll(stays).exceptAll(clean).count() == 0
    assert out.count() + stays.count() == clean.count()


def test_null_keys_are_never_merged(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (None, 2), (3, 1), (3, 2)], "k int, d int")
    assert sorted(tuple(r) for r in dedup(df, "k", ["d"]).filter("k is null").collect()) == [(None, 1), (None, 1), (None, 2)]
    assert dedup(df, "k", ["d"]).count() == 4


def test_repeated_dimension_keys_stop_the_run(spark, mart):
    twice = Layer({n: lambda n=n: mart[n].union(mart[n]) if n == "dim_company" else mart[n] for n in mart})
    check_dimension_keys(mart)
    with pytest.raises(ValueError, match="dim_company: 5"):
        check_dimension_keys(twice)
