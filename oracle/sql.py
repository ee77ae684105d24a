"""DuckDB restatement of the layers and queries, built from shared common table expressions.

Written apart from the Spark code: ledger KPIs group the fact directly, ratios are rounded in integer
arithmetic, the cube is spelled out column by column.
"""

from __future__ import annotations

# --- text helpers -------------------------------------------------------------------------------------------


def _date(column: str) -> str:
    return f"cast(try_strptime({column}, '%d-%m-%Y %H:%M') as date)"


def _money(column: str) -> str:
    return f"try_cast({column} as decimal(18,2))"


def _total(expression: str) -> str:
    return f"cast({expression} as decimal(28,2))"


def _rounded(numerator: str, denominator: str, scale: int) -> str:
    """numerator * scale / denominator to two places, half away from zero, on whole hundredths.

    Both operands are hugeint expressions; NULL for a zero denominator.
    """
    n, d = f"({numerator})", f"({denominator})"
    half_up = f"(2 * abs{n} * {scale * 100} + abs{d}) // (2 * abs{d})"
    return (
        f"case when {d} <> 0 then "
        f"cast(cast(sign{n} * sign{d} as hugeint) * ({half_up}) as decimal(28,0)) * cast(0.01 as decimal(3,2)) end"
    )


def _cents(money: str) -> str:
    return f"cast({money} * 100 as hugeint)"


def _pct(part: str, whole: str) -> str:
    return _total(_rounded(_cents(part), _cents(whole), 100))


def _mean(money: str, count: str) -> str:
    """Money divided by a count."""
    return _total(_rounded(_cents(money), f"cast({count} as hugeint) * 100", 1))


# --- raw layer over the sample tables -----------------------------------------------------------------------

_RAW = {
    "raw_accounts": """
        select cast(1000 + 10 * slot as varchar) as account_id, 'ACC-' || (1000 + 10 * slot) as account_code,
               min(p_name) as account_name, min(p_type) as account_type, min(p_brand) as category,
               'TRUE' as is_active
        from (select *, (p_partkey * 37) % 640 as slot from part) where slot % 50 <> 7 group by slot""",
    "raw_company": """
        select cast(r_regionkey + 1 as varchar) as company_id, r_name as company_name, 'Technology' as industry,
               'C' || r_regionkey as country, '15-03-20' || (r_regionkey + 10) as established_date,
               'TRUE' as is_active
        from region""",
    "raw_departments": """
        select cast(n_nationkey + 1 as varchar) as department_id,
               'DEPT-' || lpad(cast(n_nationkey + 1 as varchar), 3, '0') as department_code,
               n_name as department_name, 'CC-' || (n_nationkey + 1001) as cost_center
        from nation where n_nationkey <> 24""",
    "raw_employee": """
        select cast(c_custkey as varchar) as employee_id, 'EMP-' || c_custkey as employee_code,
               case when c_custkey % 97 = 0 then null else c_mktsegment end as first_name, c_name as last_name,
               'e' || c_custkey || '@example.com' as email, cast(c_nationkey + 1 as varchar) as department_id,
               cast(c_custkey % 5 + 1 as varchar) as company_id,
               case c_mktsegment when 'AUTOMOBILE' then 'Junior' when 'MACHINERY' then 'Junior'
                    when 'BUILDING' then 'Senior' when 'FURNITURE' then 'Manager'
                    when 'HOUSEHOLD' then 'Director' end as position,
               strftime(date '2015-01-01' + cast(c_custkey % 3000 as integer), '%d-%m-%Y %H:%M') as hire_date,
               case when c_acctbal < 0
                    then strftime(date '2016-02-01' + cast(c_custkey % 3000 as integer), '%d-%m-%Y %H:%M')
               end as termination_date,
               cast(cast(c_acctbal as decimal(18,2)) as varchar) as base_salary,
               case when c_acctbal >= 0 then 'TRUE' else 'FALSE' end as is_active
        from customer""",
    "raw_general_ledgers": """
        select case when l_orderkey % 400 = 7 then 'n/a' else cast(l_orderkey * 10 + l_linenumber as varchar) end as gl_id,
               strftime(cast(l_shipdate as date) - l_linenumber, '%d-%m-%Y %H:%M') as entry_date,
               if(l_linenumber = 7, strftime(l_shipdate, '%d-%m-%Y'), strftime(l_shipdate, '%d-%m-%Y %H:%M'))
                   as posting_date,
               cast(year(l_shipdate) as varchar) as fiscal_year, cast(month(l_shipdate) as varchar) as fiscal_period,
               cast(l_suppkey % 5 + 1 as varchar) as company_id,
               cast(1000 + 10 * ((l_partkey * 37) % 640) as varchar) as account_id,
               cast(l_orderkey % 25 + 1 as varchar) as department_id,
               if(l_linestatus = 'F', 'Debit', 'Credit') as transaction_type,
               if(l_linestatus = 'F', cast(cast(l_extendedprice as decimal(18,2)) as varchar), '0.00')
                   as debit_amount,
               if(l_linestatus = 'F', '0.00', cast(cast(l_extendedprice as decimal(18,2)) as varchar))
                   as credit_amount,
               'REF-' || l_orderkey as reference_number, 'Shipment line ' || l_linenumber as description,
               if(l_returnflag = 'R', 'Draft', 'Posted') as status, 'user' || (l_suppkey % 10) as created_by,
               if(l_returnflag = 'R', null, 'mgr' || (l_suppkey % 3)) as approved_by
        from lineitem""",
    "raw_payroll": """
        select case when o_orderkey % 400 = 7 then 'n/a' else cast(o_orderkey as varchar) end as payroll_id, cast(o_custkey as varchar) as employee_id,
               cast(o_custkey % 5 + 1 as varchar) as company_id,
               cast((o_custkey // 5) % 25 + 1 as varchar) as department_id,
               paid as pay_period_start, paid as pay_period_end, paid as pay_date,
               cast(cast(price * 1.00 as decimal(18,2)) as varchar) as gross_salary,
               cast(cast(price * 0.10 as decimal(18,2)) as varchar) as bonus,
               if(o_orderpriority = '1-URGENT', cast(cast(price * 0.07 as decimal(18,2)) as varchar), '0.00')
                   as overtime_pay,
               if(o_orderpriority = '5-LOW', null, cast(cast(price * 0.03 as decimal(18,2)) as varchar))
                   as commission,
               cast(cast(price * 0.02 as decimal(18,2)) as varchar) as allowances,
               cast(cast(price * 0.20 as decimal(18,2)) as varchar) as tax_deduction,
               cast(cast(price * 0.06 as decimal(18,2)) as varchar) as social_security,
               cast(cast(price * 0.01 as decimal(18,2)) as varchar) as health_insurance,
               cast(cast(price * 0.05 as decimal(18,2)) as varchar) as retirement_contribution,
               '0.00' as other_deductions,
               cast(cast(price * 0.68 as decimal(18,2)) as varchar) as net_salary, 'Bank' as payment_method,
               case o_orderstatus when 'F' then 'Paid' when 'O' then 'Pending' else 'Processed' end as status
        from (select *, cast(o_totalprice as decimal(18,2)) as price,
                     strftime(o_orderdate, '%d-%m-%Y %H:%M') as paid from orders)""",
}

# --- clean layer --------------------------------------------------------------------------------------------

# Money columns of the payroll table.
_PAY_MONEY = (
    "gross_salary bonus overtime_pay commission allowances tax_deduction social_security health_insurance "
    "retirement_contribution other_deductions net_salary"
).split()

_EMPLOYEE_DATES = f"{_date('hire_date')} as hire_date, {_date('termination_date')} as termination_date"
_GL_DATES = f"{_date('entry_date')} as entry_date, {_date('posting_date')} as posting_date"
_PAY_DATES = ", ".join(f"{_date(c)} as {c}" for c in ("pay_period_start", "pay_period_end", "pay_date"))

_CLEAN = {
    "clean_accounts": """
        select * replace (try_cast(account_id as integer) as account_id, try_cast(is_active as boolean) as is_active)
        from raw_accounts""",
    "clean_company": """
        select * replace (try_cast(company_id as integer) as company_id, try_cast(is_active as boolean) as is_active)
        from raw_company""",
    "clean_departments": """
        select * replace (try_cast(department_id as integer) as department_id) from raw_departments""",
    "clean_employee": f"""
        select * replace (try_cast(employee_id as bigint) as employee_id,
                          try_cast(department_id as integer) as department_id,
                          try_cast(company_id as integer) as company_id, {_EMPLOYEE_DATES},
                          {_money('base_salary')} as base_salary, try_cast(is_active as boolean) as is_active)
        from raw_employee""",
    "clean_general_ledgers": f"""
        select * replace (try_cast(gl_id as bigint) as gl_id, {_GL_DATES},
                          try_cast(fiscal_year as integer) as fiscal_year,
                          try_cast(fiscal_period as integer) as fiscal_period,
                          try_cast(company_id as integer) as company_id,
                          try_cast(account_id as integer) as account_id,
                          try_cast(department_id as integer) as department_id,
                          {_money('debit_amount')} as debit_amount, {_money('credit_amount')} as credit_amount)
        from raw_general_ledgers""",
    "clean_payroll": f"""
        select * replace (try_cast(payroll_id as bigint) as payroll_id, try_cast(employee_id as bigint) as employee_id,
                          try_cast(company_id as integer) as company_id,
                          try_cast(department_id as integer) as department_id, {_PAY_DATES},
                          {", ".join(f"{_money(c)} as {c}" for c in _PAY_MONEY)})
        from raw_payroll""",
}

# --- silver layer -------------------------------------------------------------------------------------------

_LABEL = "cast({y} as varchar) || '-' || lpad(cast({p} as varchar), 2, '0') as fiscal_month_label"

_SILVER = {
    "silver_accounts": "select * exclude (account_code) from clean_accounts",
    "silver_company": "select * from clean_company",
    "silver_departments": "select * exclude (department_code) from clean_departments",
    "silver_employee": """
        select * exclude (employee_code, first_name, last_name), concat_ws(' ', first_name, last_name) as FullName
        from clean_employee""",
    "silver_general_ledgers": f"""
        select * exclude (reference_number, description),
               cast(credit_amount - debit_amount as decimal(18,2)) as net_amount,
               {_LABEL.format(y="fiscal_year", p="fiscal_period")}
        from clean_general_ledgers""",
    "silver_payroll": f"""
        select *, {_LABEL.format(y="fiscal_year", p="fiscal_period")}
        from (select * exclude (payment_method),
                     cast(gross_salary + bonus + overtime_pay + commission + allowances as decimal(18,2))
                         as total_compensation,
                     cast(tax_deduction + social_security + health_insurance + retirement_contribution
                          + other_deductions as decimal(18,2)) as total_deductions,
                     cast(year(pay_date) as integer) as fiscal_year, cast(month(pay_date) as integer) as fiscal_period
              from clean_payroll)""",
}

# --- star schema --------------------------------------------------------------------------------------------

_MART = {
    "dim_account": """
        select *, case when account_id between 4000 and 4999 then 'Revenue'
                       when account_id between 5000 and 5999 then 'COGS'
                       when account_id between 6000 and 7099 then 'Operating Expense'
                       when account_id between 7100 and 7199 then 'Tax'
                       else 'Balance Sheet' end as pl_section,
               case when account_id between 6000 and 7099
                    -- fixed values: one category for each hundred account numbers
                    then (['Personnel', 'Occupancy', 'Technology', 'Marketing', 'Travel & Entertainment',
                           'Professional Fees', 'Communications', 'Financial Charges',
                           'Depreciation & Amortisation', 'Other Operating', 'R&D'])[account_id // 100 - 59]
               end as opex_category
        from silver_accounts""",
    "dim_departments": "select department_id, department_name, cost_center from silver_departments",
    "dim_employee": """
        select employee_id, FullName, email, department_id, company_id, position, hire_date, termination_date,
               base_salary, is_active
        from silver_employee""",
    "dim_company": """
        select company_id, company_name, industry, country, established_date, is_active from silver_company""",
    "fact_gl": """
        select l.*, a.pl_section, a.opex_category, a.account_type, a.account_name
        from silver_general_ledgers l left join dim_account a using (account_id)
        where l.status = 'Posted'""",
    "fact_payroll": "select * from silver_payroll",
}

# --- cube ---------------------------------------------------------------------------------------------------

_NO_MONEY = "cast(null as decimal(18,2))"
_NO_TEXT = "cast(null as varchar)"
_NO_DATE = "cast(null as date)"


def _typed_nulls(null: str, names: str) -> str:
    return ", ".join(f"{null} as {n}" for n in names.split())


_SHARED = """d.department_id, d.department_name, d.cost_center, c.company_id, c.company_name, c.industry, c.country,
               c.established_date as company_established_date, c.is_active as company_is_active"""
# Measures of the cube.
_PAY_MEASURES = (
    "gross_salary bonus overtime_pay commission allowances total_compensation tax_deduction social_security "
    "health_insurance retirement_contribution other_deductions total_deductions net_salary"
)

_CUBE = {
    "cube_payroll": f"""
        select 'PAYROLL' as source_fact, p.payroll_id as transaction_id, p.pay_date as transaction_date,
               p.pay_period_start, p.pay_period_end, p.fiscal_year, p.fiscal_period, p.fiscal_month_label,
               e.employee_id, e.FullName as employee_name, e.email as employee_email,
               e.position as employee_position, e.hire_date, e.termination_date,
               e.base_salary as employee_base_salary, e.is_active as employee_is_active,
               {_SHARED},
               {_typed_nulls(_NO_TEXT, "account_id account_name account_type account_category")},
               {", ".join("p." + m for m in _PAY_MEASURES.split())},
               {_typed_nulls(_NO_MONEY, "debit_amount credit_amount net_amount")},
               {_typed_nulls(_NO_TEXT, "transaction_type pl_section opex_category")},
               p.status, {_typed_nulls(_NO_TEXT, "created_by approved_by")}
        from fact_payroll p
        left join dim_employee e on e.employee_id = p.employee_id
        left join dim_departments d on d.department_id = p.department_id
        left join dim_company c on c.company_id = p.company_id""",
    "cube_gl": f"""
        select 'GENERAL_LEDGER' as source_fact, g.gl_id as transaction_id, g.posting_date as transaction_date,
               {_typed_nulls(_NO_DATE, "pay_period_start pay_period_end")},
               g.fiscal_year, g.fiscal_period, g.fiscal_month_label, cast(null as bigint) as employee_id,
               {_typed_nulls(_NO_TEXT, "employee_name employee_email employee_position")},
               {_typed_nulls(_NO_DATE, "hire_date termination_date")}, {_NO_MONEY} as employee_base_salary,
               cast(null as boolean) as employee_is_active,
               {_SHARED},
               cast(a.account_id as varchar) as account_id, a.account_name, a.account_type,
               a.category as account_category,
               {_typed_nulls(_NO_MONEY, _PAY_MEASURES)},
               g.debit_amount, g.credit_amount, g.net_amount, g.transaction_type, g.pl_section, g.opex_category,
               g.status, g.created_by, g.approved_by
        from fact_gl g
        left join dim_account a on a.account_id = g.account_id
        left join dim_departments d on d.department_id = g.department_id
        left join dim_company c on c.company_id = g.company_id""",
    "cube": "select * from cube_payroll union all by name select * from cube_gl",
}

CTES: dict[str, str] = {**_RAW, **_CLEAN, **_SILVER, **_MART, **_CUBE}


def over_layers(query: str) -> str:
    """A query over the layers as one statement over the sample tables."""
    chain = ",\n".join(f"{name} as ({body})" for name, body in CTES.items())
    return f"with {chain}\n{query}"


# --- KPIs ---------------------------------------------------------------------------------------------------

_MONTH = "fiscal_year, fiscal_period, fiscal_month_label"


def _section(section: str, side: str) -> str:
    """Sum of one section's side within the group, 0 where the group has none of it."""
    return (
        f"case when count(*) filter (pl_section is distinct from '{section}') > 0 "
        f"then coalesce(sum({side}) filter (pl_section = '{section}'), 0) "
        f"else sum({side}) end"
    )


KPI_SQL: dict[str, str] = {
    "kpi1_monthly_consolidated_revenue": f"""
        select {_MONTH}, {_total("revenue")} as total_revenue, {_total("before")} as prev_month_revenue,
               {_pct("(revenue - before)", "before")} as mom_growth_pct
        from (select *, lag(revenue) over (order by fiscal_year, fiscal_period) as before
              from (select {_MONTH}, {_total("sum(credit_amount)")} as revenue from fact_gl
                    where pl_section = 'Revenue' group by all))""",
    "kpi2_cost_of_sales_by_month": f"""
        select {_MONTH}, company_id, company_name, {_total("sum(debit_amount)")} as cost_of_sales
        from fact_gl join dim_company using (company_id) where pl_section = 'COGS' group by all""",
    "kpi3_gross_profit_margin": f"""
        select *, {_total("revenue - cogs")} as gross_profit,
               {_pct("(revenue - cogs)", "revenue")} as gross_profit_margin_pct
        from (select {_MONTH}, company_id, company_name, {_total(_section("Revenue", "credit_amount"))} as revenue,
                     {_total(_section("COGS", "debit_amount"))} as cogs
              from fact_gl join dim_company using (company_id)
              where pl_section in ('Revenue', 'COGS') group by all)""",
    "kpi4_opex_breakdown": f"""
        select {_MONTH}, company_id, company_name, coalesce(g.opex_category, 'Other') as opex_category,
               {_total("sum(debit_amount)")} as opex_amount
        from fact_gl g join dim_company using (company_id) where pl_section = 'Operating Expense'
        group by fiscal_year, fiscal_period, fiscal_month_label, company_id, company_name,
                 coalesce(g.opex_category, 'Other')""",
    "kpi5_avg_compensation_by_position": f"""
        select p.company_id, c.company_name, e.position, count(distinct p.employee_id) as employee_count,
               {_mean("sum(p.total_compensation)", "count(p.total_compensation)")} as avg_total_compensation,
               {_mean("sum(p.gross_salary)", "count(p.gross_salary)")} as avg_gross_salary,
               {_mean("sum(p.bonus)", "count(p.bonus)")} as avg_bonus,
               {_mean("sum(p.overtime_pay)", "count(p.overtime_pay)")} as avg_overtime,
               {_mean("sum(p.commission)", "count(p.commission)")} as avg_commission,
               {_mean("sum(p.allowances)", "count(p.allowances)")} as avg_allowances
        from fact_payroll p join dim_employee e using (employee_id) join dim_company c on c.company_id = p.company_id
        group by all""",
    "kpi6_net_profit_by_month": f"""
        select {_MONTH}, company_id, company_name, revenue, cogs, {_total("revenue - cogs")} as gross_profit,
               operating_expenses, {_total("revenue - cogs - operating_expenses")} as ebit, tax_expense,
               {_total("revenue - cogs - operating_expenses - tax_expense")} as net_profit,
               {_pct("(revenue - cogs - operating_expenses - tax_expense)", "revenue")} as net_profit_margin_pct
        from (select {_MONTH}, company_id, company_name, {_total(_section("Revenue", "credit_amount"))} as revenue,
                     {_total(_section("COGS", "debit_amount"))} as cogs,
                     {_total(_section("Operating Expense", "debit_amount"))} as operating_expenses,
                     {_total(_section("Tax", "debit_amount"))} as tax_expense
              from fact_gl join dim_company using (company_id) group by all)""",
    "kpi7_overtime_bonus_analysis": f"""
        select p.company_id, c.company_name, p.department_id, d.department_name,
               {_total("sum(overtime_pay)")} as total_overtime_pay, {_total("sum(bonus)")} as total_bonus,
               {_total("sum(gross_salary)")} as total_gross_salary, {_total("sum(commission)")} as total_commission,
               {_pct("sum(overtime_pay)", "sum(gross_salary)")} as overtime_to_base_ratio_pct,
               {_pct("sum(bonus)", "sum(gross_salary)")} as bonus_to_base_ratio_pct,
               count(distinct employee_id) as employee_count
        from fact_payroll p join dim_departments d using (department_id) join dim_company c using (company_id)
        group by all""",
    "kpi8_cost_per_department": f"""
        select p.company_id, c.company_name, p.department_id, d.department_name, d.cost_center,
               {_total("sum(total_compensation)")} as total_compensation_cost,
               {_total("sum(gross_salary)")} as total_gross_salary, {_total("sum(bonus)")} as total_bonus,
               {_total("sum(overtime_pay)")} as total_overtime, {_total("sum(commission)")} as total_commission,
               {_total("sum(allowances)")} as total_allowances, count(distinct employee_id) as employee_count,
               {_mean("sum(total_compensation)", "count(distinct employee_id)")} as cost_per_employee
        from fact_payroll p join dim_departments d using (department_id) join dim_company c using (company_id)
        group by all""",
    "kpi9_headcount_by_department": f"""
        select e.company_id, c.company_name, e.department_id, d.department_name, d.cost_center,
               count(*) as active_headcount, count(*) filter (position = 'Junior') as junior_count,
               count(*) filter (position = 'Senior') as senior_count,
               count(*) filter (position = 'Manager') as manager_count,
               {_mean("sum(base_salary)", "count(base_salary)")} as avg_base_salary,
               {_total("sum(base_salary)")} as total_annual_base_cost
        from dim_employee e join dim_departments d using (department_id) join dim_company c using (company_id)
        where e.is_active group by all""",
    "kpi10_payroll_cost_pct_revenue": f"""
        select r.{_MONTH.replace(", ", ", r.")}, r.company_id, c.company_name, r.revenue as total_revenue,
               p.cost as total_payroll_cost, p.headcount, {_pct("p.cost", "r.revenue")} as payroll_pct_of_revenue,
               {_mean("r.revenue", "p.headcount")} as revenue_per_employee
        from (select {_MONTH}, company_id, {_total("sum(credit_amount)")} as revenue from fact_gl
              where pl_section = 'Revenue' group by all) r
        join (select fiscal_year, fiscal_period, company_id, {_total("sum(total_compensation)")} as cost,
                     count(distinct employee_id) as headcount
              from fact_payroll group by all) p using (fiscal_year, fiscal_period, company_id)
        join dim_company c using (company_id)""",
}

# --- all queries --------------------------------------------------------------------------------------------


def _null_counts(table: str, kinds: dict[str, str]) -> str:
    """One row per column: the raw text against its cleaned value."""
    return " union all ".join(
        f"""select '{table}' as table_name, '{column}' as column_name, count(*) as n_rows,
                   count(*) filter ({value} is null) as n_null,
                   count(*) filter ({value} is null and {column} <> '') as n_unparsed from raw_{table}"""
        for column, value in kinds.items()
    )


def _casts(ints: str = "", longs: str = "", money: str = "", dates: str = "", flags: str = "", text: str = "") -> dict:
    return {
        **{c: f"try_cast({c} as integer)" for c in ints.split()},
        **{c: f"try_cast({c} as bigint)" for c in longs.split()},
        **{c: _money(c) for c in money.split()},
        **{c: _date(c) for c in dates.split()},
        **{c: f"try_cast({c} as boolean)" for c in flags.split()},
        **{c: c for c in text.split()},
    }


_NULL_COUNTS = " union all ".join(
    [
        _null_counts(
            "accounts",
            _casts(ints="account_id", flags="is_active", text="account_code account_name account_type category"),
        ),
        _null_counts(
            "company",
            _casts(ints="company_id", flags="is_active", text="company_name industry country established_date"),
        ),
        _null_counts(
            "departments", _casts(ints="department_id", text="department_code department_name cost_center")
        ),
        _null_counts(
            "employee",
            _casts(
                ints="department_id company_id",
                longs="employee_id",
                money="base_salary",
                dates="hire_date termination_date",
                flags="is_active",
                text="employee_code first_name last_name email position",
            ),
        ),
        _null_counts(
            "general_ledgers",
            _casts(
                ints="fiscal_year fiscal_period company_id account_id department_id",
                longs="gl_id",
                money="debit_amount credit_amount",
                dates="entry_date posting_date",
                text="transaction_type reference_number description status created_by approved_by",
            ),
        ),
        _null_counts(
            "payroll",
            _casts(
                ints="company_id department_id",
                longs="payroll_id employee_id",
                money=" ".join(_PAY_MONEY),
                dates="pay_period_start pay_period_end pay_date",
                text="payment_method status",
            ),
        ),
    ]
)


def _orphans(fact: str, column: str, dimension: str) -> str:
    return f"""
        select '{fact}' as fact_name, '{column}' as foreign_key, cast({column} as varchar) as key_value,
               count(*) as n_rows
        from {fact} where {column} not in (select {column} from {dimension}) group by all"""


_LEDGER_ORDER = (
    "posting_date desc nulls last, entry_date desc nulls last, fiscal_year nulls first, fiscal_period nulls first, "
    "company_id nulls first, account_id nulls first, department_id nulls first, transaction_type nulls first, "
    "debit_amount nulls first, credit_amount nulls first, reference_number nulls first, description nulls first, "
    "status nulls first, created_by nulls first, approved_by nulls first"
)

_SAMPLE = """
    select source_fact, transaction_id, transaction_date, fiscal_year, fiscal_period, company_name, department_name,
           employee_name, account_name, amount, status
    from (select 'GENERAL_LEDGER' as source_fact, g.gl_id as transaction_id, g.posting_date as transaction_date,
                 g.fiscal_year, g.fiscal_period, c.company_name, d.department_name,
                 cast(null as varchar) as employee_name, a.account_name, g.net_amount as amount, g.status,
                 g.account_id as k1, g.company_id as k2, g.department_id as k3
          from fact_gl g left join dim_account a on a.account_id = g.account_id
          left join dim_departments d on d.department_id = g.department_id
          left join dim_company c on c.company_id = g.company_id
          union all
          select 'PAYROLL', p.payroll_id, p.pay_date, p.fiscal_year, p.fiscal_period, c.company_name,
                 d.department_name, e.FullName, cast(null as varchar), p.total_compensation, p.status,
                 p.employee_id, p.company_id, p.department_id
          from fact_payroll p left join dim_employee e on e.employee_id = p.employee_id
          left join dim_departments d on d.department_id = p.department_id
          left join dim_company c on c.company_id = p.company_id)
    order by source_fact, transaction_id nulls first, transaction_date nulls first, k1 nulls first, k2 nulls first,
             k3 nulls first, amount nulls first, status nulls first
    limit 10"""

_MONTH_COMPANY = f"{_MONTH}, company_id, company_name"
_DEPARTMENT = "company_id, company_name, department_id, department_name"
_KPI_ROWS = {
    "kpi1_monthly_consolidated_revenue": _MONTH,
    "kpi2_cost_of_sales_by_month": _MONTH_COMPANY,
    "kpi3_gross_profit_margin": _MONTH_COMPANY,
    "kpi4_opex_breakdown": f"{_MONTH_COMPANY}, opex_category",
    "kpi5_avg_compensation_by_position": "company_id, company_name, position",
    "kpi6_net_profit_by_month": _MONTH_COMPANY,
    "kpi7_overtime_bonus_analysis": _DEPARTMENT,
    "kpi8_cost_per_department": f"{_DEPARTMENT}, cost_center",
    "kpi9_headcount_by_department": f"{_DEPARTMENT}, cost_center",
    "kpi10_payroll_cost_pct_revenue": _MONTH_COMPANY,
}


def _every_value(name: str, body: str, keys: str) -> str:
    key = ", ".join(f"coalesce(cast({k} as varchar), '')" for k in keys.split(", "))
    return f"""
        select '{name}' as kpi, row_key, measure, value
        from (select concat_ws('|', {key}) as row_key,
                     cast(cast(columns(* exclude ({keys})) as decimal(28,2)) as varchar)
              from ({body}))
        unpivot include nulls (value for measure in (columns(* exclude (row_key))))"""


_KEYS = {
    "accounts": "account_id",
    "company": "company_id",
    "departments": "department_id",
    "employee": "employee_id",
    "general_ledgers": "gl_id",
    "payroll": "payroll_id",
}

_ROWS_OF_TABLES = " union all ".join(
    f"select '{name}' as table_name, count(*) as n_rows, count(distinct {key}) as n_keys, "
    f"coalesce(sum(length(concat_ws('|', *columns(*)))), 0)::bigint as text_length, "
    f"{int(name == 'accounts')}::bigint as n_rejects from raw_{name}"
    for name, key in _KEYS.items()
)

_FACT_GL_ORDER = (
    "gl_id, entry_date, posting_date, fiscal_year, fiscal_period, fiscal_month_label, company_id, account_id, "
    "department_id, transaction_type, debit_amount, credit_amount, net_amount, pl_section, opex_category, "
    "account_type, account_name, status, created_by, approved_by"
)

_ONE_LEDGER_LINE = f"""(select * from (select distinct * from clean_general_ledgers where gl_id is not null)
                      qualify row_number() over (partition by gl_id order by {_LEDGER_ORDER}) = 1)"""

_DEDUPLICATED = f"""
        select * from {_ONE_LEDGER_LINE}
        union all select * from clean_general_ledgers where gl_id is null"""

_BODIES: dict[str, str] = {
    "scan_accounts": "select * from raw_accounts",
    "csv_landing": "select * from raw_accounts",
    "ingest_manifest": _ROWS_OF_TABLES,
    "raw_with_audit": "select *, 'batch-1' as _batch_id, true as has_source_file from raw_employee",
    "table_overwrite_roundtrip": "select * from dim_employee",
    "fact_gl_partition_pruned": f"select {_FACT_GL_ORDER} from fact_gl where fiscal_year = 1998",
    "fact_gl_year_replaced": f"""
        select {_FACT_GL_ORDER} from fact_gl
        where fiscal_year is distinct from 1998 or pl_section = 'Revenue'""",
    "kpi_tables_materialized": " union all ".join(
        _every_value(name, KPI_SQL[name], keys) for name, keys in _KPI_ROWS.items()
    ),
    "kpi_persistent_view": KPI_SQL["kpi6_net_profit_by_month"],
    "ingest_increment": "select * from raw_accounts",
    "table_replaced_atomically": "select * from dim_employee",
    "table_rolled_back": """
        select *, 'before' as version from dim_employee
        union all select *, 'active' from dim_employee where is_active""",
    "clean_gl_upsert": _DEDUPLICATED,
    "kpi_after_year_rerun": KPI_SQL["kpi6_net_profit_by_month"].replace(
        "from fact_gl",
        "from (select * from fact_gl where fiscal_year is distinct from 1998 or pl_section = 'Revenue')",
    ),
    "kpi6_of_country": f"""
        select k.* from ({KPI_SQL["kpi6_net_profit_by_month"]}) k
        where company_id in (select company_id from dim_company where country = 'C1')""",
    "headcount_rollup": """
        select fiscal_year, cast(ceil(fiscal_period / 3) as integer) as fiscal_quarter, company_id,
               count(distinct employee_id) as headcount
        from fact_payroll where employee_id is not null group by all
        union all
        select fiscal_year, null, company_id, count(distinct employee_id)
        from fact_payroll where employee_id is not null group by all""",
    "dq_observed": _NULL_COUNTS,
    "clean_employee_dates": f"select * replace ({_EMPLOYEE_DATES}) from raw_employee",
    "clean_gl_dates": f"select * replace ({_GL_DATES}) from raw_general_ledgers",
    "clean_payroll_dates": f"select * replace ({_PAY_DATES}) from raw_payroll",
    "clean_gl_typed": "select * from clean_general_ledgers",
    "clean_payroll_null_policy": """
        select * replace (coalesce(commission, 0) as commission),
               case when payroll_id is null or employee_id is null or pay_date is null then 'rejected' else 'kept' end
                   as disposition
        from clean_payroll""",
    "clean_gl_dedup": f"""
        select * from (select * from (select distinct * from clean_general_ledgers where gl_id is not null)
        qualify row_number() over (partition by gl_id order by {_LEDGER_ORDER}) = 1)
        union all select * from clean_general_ledgers where gl_id is null""",
    "clean_gl_rejects": f"""
        select *, 'null_key' as reject_reason from clean_general_ledgers where gl_id is null
        union all
        select *, 'duplicate_key' from (select * from clean_general_ledgers where gl_id is not null
        qualify row_number() over (partition by gl_id order by {_LEDGER_ORDER}) > 1)""",
    "raw_schema_drift": "select * replace (null::varchar as description) from clean_general_ledgers",
    "dq_schema_drift": """
        select 'general_ledgers' as table_name, d.* , case column_name
                   when 'company_id' then (select count(company_id) from clean_general_ledgers)
                   when 'status' then (select count(status) from raw_general_ledgers)
                   when 'ledger_book' then (select count(*) from raw_general_ledgers where status = 'Posted')
                   else 0 end as n_values
        from (values ('company_id', 'converted', 'string', 'int'), ('description', 'missing', 'string', null),
                     ('status', 'renamed', 'string', 'string'), ('ledger_book', 'extra', null, 'string'))
             as d(column_name, finding, declared_type, stored_type)""",
    "dq_frequent_keys": " union all ".join(
        f"select '{table}' as table_name, '{key}' as column_name, {key}::varchar as key_value, count(*) as n_rows, "
        f"(select count(*) from clean_{table}) as n_all from clean_{table} group by {key} "
        f"having count(*) * 100 >= (select count(*) from clean_{table})"
        for table, keys in {
            "general_ledgers": ("gl_id", "company_id", "account_id", "department_id", "fiscal_year"),
            "payroll": ("payroll_id", "company_id", "employee_id", "department_id"),
        }.items()
        for key in keys
    ),
    "silver_accounts": "select * from silver_accounts",
    "silver_departments": "select * from silver_departments",
    "silver_employee": "select * from silver_employee",
    "silver_gl": "select * from silver_general_ledgers",
    "silver_payroll": "select * from silver_payroll",
    "dim_account": "select * from dim_account",
    "dim_departments": "select * from dim_departments",
    "dim_employee": "select * from dim_employee",
    "dim_company": "select * from dim_company",
    "fact_gl": f"select {_FACT_GL_ORDER} from fact_gl",
    "fact_payroll": "select * from fact_payroll",
    **KPI_SQL,
    "datacube_payroll": "select * from cube_payroll",
    "datacube_payroll_bucketed": "select * from cube_payroll",
    "datacube_gl": "select * from cube_gl",
    "fact_integrated_datacube": "select * from cube",
    "datacube_profile": """
        select source_fact, count(*) as total_records, count(distinct company_id) as unique_companies,
               count(distinct department_id) as unique_departments, min(transaction_date) as earliest_transaction,
               max(transaction_date) as latest_transaction
        from cube group by source_fact""",
    "datacube_sample": _SAMPLE,
    "kpi_session_views": KPI_SQL["kpi6_net_profit_by_month"],
    "kpi1_first_months": f"""
        select * from ({KPI_SQL["kpi1_monthly_consolidated_revenue"]})
        order by fiscal_year, fiscal_period limit 5""",
    "kpi6_first_months": f"""
        select * from ({KPI_SQL["kpi6_net_profit_by_month"]})
        order by fiscal_year, fiscal_period, company_id limit 5""",
    "dq_null_counts": _NULL_COUNTS,
    "dq_duplicate_keys": " union all ".join(
        f"select '{name}' as table_name, {key}::varchar as key_value, count(*) as n_rows from clean_{name} "
        f"group by {key} having count(*) > 1"
        for name, key in _KEYS.items()
    ),
    "dq_orphans": " union all ".join(
        [
            _orphans("fact_gl", "account_id", "dim_account"),
            _orphans("fact_gl", "department_id", "dim_departments"),
            _orphans("fact_gl", "company_id", "dim_company"),
            _orphans("fact_payroll", "employee_id", "dim_employee"),
            _orphans("fact_payroll", "department_id", "dim_departments"),
            _orphans("fact_payroll", "company_id", "dim_company"),
        ]
    ),
    "dq_reconcile": f"""
        select *, n_raw = n_kept + n_rejected + n_duplicate and n_kept = n_fact + n_excluded as balanced
        from (select 'general_ledgers' as table_name, (select count(*) from raw_general_ledgers) as n_raw,
                     (select count(distinct gl_id) from clean_general_ledgers) as n_kept,
                     (select count(*) from clean_general_ledgers where gl_id is null) as n_rejected,
                     (select coalesce(sum(n - 1), 0)::bigint from (select count(*) as n from clean_general_ledgers
                      where gl_id is not null group by gl_id)) as n_duplicate,
                     (select count(*) from {_ONE_LEDGER_LINE} where status = 'Posted') as n_fact,
                     (select count(*) from {_ONE_LEDGER_LINE} where status is distinct from 'Posted') as n_excluded
              union all
              select 'payroll', (select count(*) from raw_payroll),
                     (select count(distinct payroll_id) from clean_payroll),
                     (select count(*) from clean_payroll where payroll_id is null),
                     (select coalesce(sum(n - 1), 0)::bigint from (select count(*) as n from clean_payroll
                      where payroll_id is not null group by payroll_id)),
                     (select count(distinct payroll_id) from clean_payroll), 0)""",
}

QUERIES: dict[str, str] = {name: over_layers(body) for name, body in _BODIES.items()}
