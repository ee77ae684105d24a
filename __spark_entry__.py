"""

Every query builds the layers lazily from the sample tables in the given folder. Queries that show a sink or a
landing write to a fresh place under the session's shared folder and return what they read back.
"""

from __future__ import annotations

import importlib.util
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.functions.hot import frequent_keys
from finloom.layer import Layer
from finloom.operators import cube, quality
from finloom.operators.clean import LATEST_BY, clean_layer, clean_table, dedup, null_policy, parse_dates, rejects_layer
from finloom.operators.headcount import BITMAPS, headcount_rollup, monthly_bitmaps
from finloom.operators.kpis import KPIS, first_months, long_form, net_profit_of
from finloom.operators.mart import FACT_PARTITIONS, POSTED, mart_layer
from finloom.operators.silver import silver_layer
from finloom.plans.layers import mart_of, silver_of
from finloom.plans.pipeline import materialize_kpis, publish_kpi_views, register_session_views, store
from finloom.schemas import CLEAN, KEYS, MANIFEST, MART, RAW
from finloom.scratch import fresh_folder, fresh_schema
from finloom.sinks.buckets import store_bucketed
from finloom.sinks.tables import overwrite_table, replace_partitions, write_together
from finloom.sinks.upsert import RANGE, create_keyed, upsert
from finloom.sinks.versions import replace_table, roll_back
from finloom.sources import drift, files, samples
from oracle.sql import QUERIES

Query = Callable[[SparkSession, str], DataFrame]

SMALL = "/root/testdata/sf0.001"
KPI6 = "kpi6_net_profit_by_month"


def entry(spark: SparkSession) -> DataFrame:
    """Net profit by month and company."""
    return KPIS[KPI6].build(mart_of(samples.raw_layer(spark, SMALL)))


def _on_raw(f: Callable[[Layer], DataFrame]) -> Query:
    return lambda spark, folder: f(samples.raw_layer(spark, folder))


def _on_silver(f: Callable[[Layer], DataFrame]) -> Query:
    return lambda spark, folder: f(silver_of(samples.raw_layer(spark, folder)))


def _on_mart(f: Callable[[Layer], DataFrame]) -> Query:
    return lambda spark, folder: f(mart_of(samples.raw_layer(spark, folder)))


def _clean(raw: Layer, name: str) -> DataFrame:
    return clean_table(raw[name], name)


# --- sources and sinks ---------------------------------------------------------------------------------------


def scan_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """Raw accounts stored as a table, scanned by name."""
    schema = fresh_schema(spark, "scan")
    overwrite_table(samples.raw_layer(spark, folder)["accounts"], f"{schema}.accounts")
    return spark.table(f"{schema}.accounts")


def _land(raw: Layer, name: str, landing: str) -> str:
    path = f"{landing}/{name}"
    raw[name].write.option("header", True).csv(path)
    return path


def csv_landing(spark: SparkSession, folder: str) -> DataFrame:
    path = _land(samples.raw_layer(spark, folder), "accounts", fresh_folder(spark, "landing"))
    return files.read_csv_text(spark, path, RAW["accounts"])


def raw_with_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Landed employees with audit columns; file name and time differ per run, so only their presence is shown."""
    path = _land(samples.raw_layer(spark, folder), "employee", fresh_folder(spark, "landing"))
    audited = files.with_audit(files.read_csv_text(spark, path, RAW["employee"]), "batch-1")
    present = F.col("_source_file").isNotNull() & F.col("_ingested_at").isNotNull()
    return audited.withColumn("has_source_file", present).drop("_source_file", "_ingested_at")


def ingest_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Land all six raw tables as files, accounts as three and one with a malformed line, load them as the control
    table says, and describe what was stored: rows, distinct keys, length of all text, rejected lines."""
    landing = fresh_folder(spark, "landing")
    raw = samples.raw_layer(spark, folder)
    write_together(spark, [partial(_land, raw, name, landing) for name in raw if name != "accounts"])
    accounts = raw["accounts"].withColumn("part", F.expr("crc32(CAST(account_id AS BINARY)) % 3"))
    for k in range(3):
        accounts.filter(f"part = {k}").drop("part").write.option("header", True).csv(f"{landing}/accounts_{k}.csv")
    lines = [(",".join(RAW["accounts"].names),), (",".join(["x"] * (len(RAW["accounts"].names) + 1)),)]
    spark.createDataFrame(lines, "line string").coalesce(1).write.text(f"{landing}/accounts_bad.csv")
    names = [*((f"accounts_{k}", "raw", "accounts") for k in (0, 1, 2, "bad"))]
    control = samples.manifest(spark).filter("table_name <> 'accounts'").union(spark.createDataFrame(names, MANIFEST))
    control.coalesce(1).write.option("header", True).csv(f"{landing}/meta_data")
    control = files.read_manifest(spark, f"{landing}/meta_data")
    prefix = fresh_schema(spark, "ingest") + "_"
    spark.sql(f"CREATE SCHEMA {prefix}raw LOCATION '{fresh_folder(spark, 'raw')}'")
    counts = None
    for table in files.ingest(spark, control, landing, "batch-1", schema_prefix=prefix):
        name = table.split(".")[1]
        text = f"coalesce(sum(length(concat_ws('|', {', '.join(RAW[name].names)}))), 0)"
        count = spark.table(table).selectExpr(
            f"'{name}' AS table_name", "count(*) AS n_rows", f"count(DISTINCT {KEYS[name]}) AS n_keys", f"{text} AS text_length"
        )
        count = count.withColumn("n_rejects", F.lit(spark.table(f"{table}_rejects").count()).cast("bigint"))
        counts = count if counts is None else counts.unionByName(count)
    return counts


def table_overwrite_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Write the employee dimension twice; the second write replaces the first."""
    table = f"{fresh_schema(spark, 'roundtrip')}.dim_employee"
    employees = mart_of(samples.raw_layer(spark, folder))["dim_employee"]
    for _ in range(2):
        overwrite_table(employees, table)
    return spark.table(table)


def fact_gl_partition_pruned(spark: SparkSession, folder: str) -> DataFrame:
    """Store the whole ledger fact partitioned by year and company, then read one fiscal year."""
    table = f"{fresh_schema(spark, 'facts')}.fact_gl"
    overwrite_table(mart_of(samples.raw_layer(spark, folder))["fact_gl"], table, partition_by=FACT_PARTITIONS)
    return spark.table(table).filter(F.col("fiscal_year") == 1998).select(*MART["fact_gl"].names)


def kpi_tables_materialized(spark: SparkSession, folder: str) -> DataFrame:
    """All ten KPI tables, every value of each in long form. The star schema is stored first, so that no KPI parses raw text again; of the ledger
    only the monthly rollup is."""
    schema = fresh_schema(spark, "kpis")
    mart = mart_of(samples.raw_layer(spark, folder))
    stored = store(spark, Layer({n: lambda n=n: mart[n] for n in MART if n != "fact_gl"}), schema)
    whole = Layer({**{n: lambda n=n: stored[n] for n in stored}, "fact_gl": lambda: mart["fact_gl"]})
    materialize_kpis(spark, whole, schema)
    return reduce(DataFrame.unionByName, [long_form(spark.table(f"{schema}.{name}"), name) for name in KPIS])


def fact_gl_year_replaced(spark: SparkSession, folder: str) -> DataFrame:
    """Store the whole ledger fact, replace 1998 with its revenue lines alone, and read all years back."""
    table = f"{fresh_schema(spark, 'rerun')}.fact_gl"
    fact = mart_of(samples.raw_layer(spark, folder))["fact_gl"]
    overwrite_table(fact, table, partition_by=FACT_PARTITIONS)
    replace_partitions(fact.filter("pl_section = 'Revenue'"), table, {"fiscal_year": 1998})
    return spark.table(table).select(*MART["fact_gl"].names)


def kpi_persistent_view(spark: SparkSession, folder: str) -> DataFrame:
    """KPI 6 stored as a table and shown through a persistent view."""
    mart = mart_of(samples.raw_layer(spark, folder))
    tables, views = fresh_schema(spark, "kpis"), fresh_schema(spark, "curated")
    materialize_kpis(spark, mart, tables, [KPI6])
    publish_kpi_views(spark, tables, views, [KPI6])
    return spark.table(f"{views}.{KPIS[KPI6].view}")


def ingest_increment(spark: SparkSession, folder: str) -> DataFrame:
    """Accounts land as three files, the last after two runs have taken in the others; the table after three runs."""
    landing, prefix = fresh_folder(spark, "landing"), fresh_schema(spark, "increment") + "_"
    spark.sql(f"CREATE SCHEMA {prefix}raw LOCATION '{fresh_folder(spark, 'raw')}'")
    accounts = samples.raw_layer(spark, folder)["accounts"].withColumn("part", F.expr("crc32(CAST(account_id AS BINARY)) % 3"))
    state, table = fresh_folder(spark, "increment-state"), f"{prefix}raw.accounts"

    def control(n: int) -> DataFrame:
        return spark.createDataFrame([(f"accounts_{k}", "raw", "accounts") for k in range(n)], MANIFEST)

    for k in range(2):
        accounts.filter(f"part = {k}").drop("part").write.option("header", True).csv(f"{landing}/accounts_{k}.csv")
    for batch in ("batch-1", "batch-2"):
        files.ingest_increment(spark, control(2), landing, batch, state, prefix)
    accounts.filter("part = 2").drop("part").write.option("header", True).csv(f"{landing}/accounts_2.csv")
    files.ingest_increment(spark, control(3), landing, "batch-3", state, prefix)
    return spark.table(table).select(*RAW["accounts"].names)


def table_replaced_atomically(spark: SparkSession, folder: str) -> DataFrame:
    """The employee dimension as a versioned table, then a replacement that fails on its last rows; what readers see."""
    table = f"{fresh_schema(spark, 'atomic')}.dim_employee"
    employees = mart_of(samples.raw_layer(spark, folder))["dim_employee"]
    replace_table(employees, table)
    last = spark.table(table).agg(F.max("employee_id")).first()[0]
    failing = spark.table(table).filter(F.expr(f"assert_true(employee_id < {last}) IS NULL"))
    try:
        replace_table(failing, table)
    except Exception as e:  # the failure is the point; anything else that went wrong would show below
        if "USER_RAISED_EXCEPTION" not in str(e):
            raise
    return spark.table(table)


def table_rolled_back(spark: SparkSession, folder: str) -> DataFrame:
    """Employees replaced by the active ones among them, read from the table itself, then one version back."""
    table = f"{fresh_schema(spark, 'versions')}.dim_employee"
    replace_table(mart_of(samples.raw_layer(spark, folder))["dim_employee"], table)
    replace_table(spark.table(table).filter("is_active"), table)
    active = spark.table(table)
    both = active.withColumn("version", F.lit("active"))
    roll_back(spark, table)
    return both.unionByName(spark.table(table).withColumn("version", F.lit("before")))


def clean_gl_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Ledger lines of two thirds of the periods stored by key, the late third merged in; one row per key."""
    table = f"{fresh_schema(spark, 'upsert')}.general_ledgers"
    lines = _clean(samples.raw_layer(spark, folder), "general_ledgers")
    late, latest = F.expr("coalesce(fiscal_period % 3 = 0, true)"), LATEST_BY["general_ledgers"]
    create_keyed(lines.filter(~late), table, "gl_id", 50_000, latest)
    upsert(lines.filter(late), table, "gl_id", latest)
    return spark.table(table).drop(RANGE)


def kpi_after_year_rerun(spark: SparkSession, folder: str) -> DataFrame:
    """Net profit after 1998 was replaced by its revenue lines: only that year of the ledger is summed again."""
    schema = fresh_schema(spark, "increment")
    mart = mart_of(samples.raw_layer(spark, folder))
    overwrite_table(mart["fact_gl"], f"{schema}.fact_gl", partition_by=FACT_PARTITIONS)
    stored = Layer({**{n: lambda n=n: mart[n] for n in MART}, "fact_gl": lambda: spark.table(f"{schema}.fact_gl")})
    materialize_kpis(spark, stored, schema, [KPI6])
    replace_partitions(mart["fact_gl"].filter("pl_section = 'Revenue'"), f"{schema}.fact_gl", {"fiscal_year": 1998})
    stored = Layer({**{n: lambda n=n: mart[n] for n in MART}, "fact_gl": lambda: spark.table(f"{schema}.fact_gl")})
    materialize_kpis(spark, stored, schema, [KPI6], year=1998)
    return spark.table(f"{schema}.{KPI6}")


def kpi6_of_country(spark: SparkSession, folder: str) -> DataFrame:
    """Net profit of one country's companies, from a ledger stored by year and company."""
    schema = fresh_schema(spark, "country")
    mart = mart_of(samples.raw_layer(spark, folder))
    overwrite_table(mart["fact_gl"], f"{schema}.fact_gl", partition_by=FACT_PARTITIONS)
    stored = Layer({**{n: lambda n=n: mart[n] for n in MART}, "fact_gl": lambda: spark.table(f"{schema}.fact_gl")})
    return net_profit_of(stored, "country = 'C1'")


def headcounts(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct employees by quarter and year, from stored monthly bitmaps."""
    table = f"{fresh_schema(spark, 'headcount')}.{BITMAPS}"
    overwrite_table(monthly_bitmaps(mart_of(samples.raw_layer(spark, folder))["fact_payroll"]), table, partition_by=["fiscal_year"])
    return headcount_rollup(spark.table(table))


# Enough for the sample tables; stored tables of other sizes take `buckets.bucket_count` of their rows.
BUCKETS = 8


def datacube_payroll_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """The cube's payroll rows from payroll and workforce stored by employee; payroll's hot employees, if any, apart."""
    schema = fresh_schema(spark, "buckets")
    mart = mart_of(samples.raw_layer(spark, folder))
    fact = store_bucketed(mart["fact_payroll"], f"{schema}.fact_payroll", "employee_id", BUCKETS)
    people = store_bucketed(mart["dim_employee"], f"{schema}.dim_employee", "employee_id", BUCKETS, hot=())
    return cube.payroll_branch_bucketed(mart, fact, people)


def _drifted(spark: SparkSession, folder: str) -> str:
    """A schema with the raw ledger as another system might hand it over: a column less, one more, one spelt otherwise and
    one as a number."""
    schema = fresh_schema(spark, "drift")
    lines = samples.raw_layer(spark, folder)["general_ledgers"].drop("description")
    lines = lines.withColumnRenamed("status", "Status").withColumn("company_id", F.expr("try_cast(company_id AS INT)"))
    lines = lines.withColumn("ledger_book", F.expr("CASE WHEN Status = 'Posted' THEN 'main' END"))
    overwrite_table(lines, f"{schema}.general_ledgers")
    return schema


def raw_schema_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Clean ledger lines from a drifted raw table."""
    raw = drift.stored_as_declared(spark, _drifted(spark, folder), {"general_ledgers": RAW["general_ledgers"]})
    return _clean(raw, "general_ledgers")


def dq_schema_drift(spark: SparkSession, folder: str) -> DataFrame:
    """What was found different in a drifted raw table."""
    schemas = {"general_ledgers": RAW["general_ledgers"]}
    return drift.findings(spark, Layer.stored(spark, _drifted(spark, folder), schemas), schemas)


# --- data quality --------------------------------------------------------------------------------------------


def dq_null_counts(raw: Layer) -> DataFrame:
    return reduce(DataFrame.unionByName, [quality.null_counts(raw[name], CLEAN[name], name) for name in CLEAN])


def dq_observed(spark: SparkSession, folder: str) -> DataFrame:
    """Null counts taken while the clean tables are written."""
    raw = samples.raw_layer(spark, folder)
    observed = {n: quality.ObservedNulls(raw[n], CLEAN[n], n) for n in CLEAN}
    watched = Layer({n: lambda n=n: observed[n].rows for n in CLEAN})
    store(spark, clean_layer(watched), fresh_schema(spark, "observed"))
    return quality.observed_counts(spark, observed.values())


def dq_duplicate_keys(raw: Layer) -> DataFrame:
    return quality.duplicate_keys_of(Layer({n: lambda n=n: _clean(raw, n) for n in CLEAN}), KEYS)


def dq_frequent_keys(raw: Layer) -> DataFrame:
    """Values of the facts' keys that hold a hundredth of their rows or more: what joins and groupings meet as skew."""
    ledger = ("gl_id", "company_id", "account_id", "department_id", "fiscal_year")
    pay = ("payroll_id", "company_id", "employee_id", "department_id")
    found = [frequent_keys(_clean(raw, name), name, keys) for name, keys in (("general_ledgers", ledger), ("payroll", pay))]
    return reduce(DataFrame.unionByName, found)


def dq_orphans(silver: Layer) -> DataFrame:
    """Posted ledger lines are checked as they are, not joined to accounts first."""
    mart = mart_layer(silver)
    posted = silver["general_ledgers"].filter(f"status = '{POSTED}'")
    shared = {"department_id": mart["dim_departments"], "company_id": mart["dim_company"]}
    ledger = quality.orphans(posted, "fact_gl", {"account_id": mart["dim_account"], **shared})
    pay = quality.orphans(mart["fact_payroll"], "fact_payroll", {"employee_id": mart["dim_employee"], **shared})
    return ledger.unionByName(pay)


def dq_reconcile(raw: Layer) -> DataFrame:
    mart = mart_layer(silver_layer(clean_layer(raw, one_row_per_key=True)))

    def of(name: str, fact: str, in_fact: str) -> DataFrame:
        return quality.reconcile(name, _clean(raw, name), KEYS[name], in_fact, mart[fact])

    ledger = of("general_ledgers", "fact_gl", f"status = '{POSTED}'")
    return ledger.unionByName(of("payroll", "fact_payroll", "true"))


def kpi_session_views(spark: SparkSession, folder: str) -> DataFrame:
    """Star schema and KPIs as session views, KPI 6 asked for in SQL."""
    register_session_views(mart_of(samples.raw_layer(spark, folder)))
    return spark.sql(f"SELECT * FROM {KPIS[KPI6].view}")


def reference_queries() -> dict[str, Query]:
    registered: dict[str, Query] = {
        "scan_accounts": scan_accounts,
        "csv_landing": csv_landing,
        "ingest_manifest": ingest_manifest,
        "raw_with_audit": raw_with_audit,
        "table_overwrite_roundtrip": table_overwrite_roundtrip,
        "fact_gl_partition_pruned": fact_gl_partition_pruned,
        "fact_gl_year_replaced": fact_gl_year_replaced,
        "kpi_tables_materialized": kpi_tables_materialized,
        "kpi_persistent_view": kpi_persistent_view,
        "ingest_increment": ingest_increment,
        "table_replaced_atomically": table_replaced_atomically,
        "table_rolled_back": table_rolled_back,
        "clean_gl_upsert": clean_gl_upsert,
        "kpi_after_year_rerun": kpi_after_year_rerun,
        "kpi6_of_country": kpi6_of_country,
        "headcount_rollup": headcounts,
        "dq_observed": dq_observed,
        "datacube_payroll_bucketed": datacube_payroll_bucketed,
        "raw_schema_drift": raw_schema_drift,
        "dq_schema_drift": dq_schema_drift,
        "dq_frequent_keys": _on_raw(dq_frequent_keys),
        "clean_employee_dates": _on_raw(lambda raw: parse_dates(raw["employee"], CLEAN["employee"])),
        "clean_gl_dates": _on_raw(lambda raw: parse_dates(raw["general_ledgers"], CLEAN["general_ledgers"])),
        "clean_payroll_dates": _on_raw(lambda raw: parse_dates(raw["payroll"], CLEAN["payroll"])),
        "clean_gl_typed": _on_raw(lambda raw: _clean(raw, "general_ledgers")),
        "clean_payroll_null_policy": _on_raw(
            lambda raw: null_policy(_clean(raw, "payroll"), ["payroll_id", "employee_id", "pay_date"], ["commission"])
        ),
        "clean_gl_dedup": _on_raw(
            lambda raw: dedup(_clean(raw, "general_ledgers"), "gl_id", LATEST_BY["general_ledgers"])
        ),
        "silver_accounts": _on_silver(lambda silver: silver["accounts"]),
        "silver_departments": _on_silver(lambda silver: silver["departments"]),
        "silver_employee": _on_silver(lambda silver: silver["employee"]),
        "silver_gl": _on_silver(lambda silver: silver["general_ledgers"]),
        "silver_payroll": _on_silver(lambda silver: silver["payroll"]),
        **{name: _on_mart(lambda mart, name=name: mart[name]) for name in MART},
        **{name: _on_mart(kpi.build) for name, kpi in KPIS.items()},
        "datacube_payroll": _on_mart(cube.payroll_branch),
        "datacube_gl": _on_mart(cube.gl_branch),
        "fact_integrated_datacube": _on_mart(cube.integrated_cube),
        "datacube_profile": _on_mart(lambda mart: cube.profile(cube.integrated_cube(mart, cube.PROFILE_COLUMNS))),
        "datacube_sample": _on_mart(cube.sample),
        "kpi_session_views": kpi_session_views,
        "kpi1_first_months": _on_mart(lambda mart: first_months(KPIS["kpi1_monthly_consolidated_revenue"].build(mart))),
        "clean_gl_rejects": _on_raw(lambda raw: rejects_layer(raw)["general_ledgers_rejects"]),
        "kpi6_first_months": _on_mart(lambda mart: first_months(KPIS[KPI6].build(mart))),
        "dq_null_counts": _on_raw(dq_null_counts),
        "dq_duplicate_keys": _on_raw(dq_duplicate_keys),
        "dq_orphans": _on_silver(dq_orphans),
        "dq_reconcile": _on_raw(dq_reconcile),
    }
    return registered


def _optional() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and check SQL of the corpus subpackage, none where it is not installed."""
    specs = [importlib.util.find_spec("finloom.llm"), importlib.util.find_spec("corpus_pipeline")]
    if any(s is None or s.origin is None for s in specs):
        return {}, {}
    import corpus_pipeline
    from finloom.llm import queries as llm
    from finloom.llm import sql

    return {"pipeline": corpus_pipeline.run, **llm.queries()}, dict(sql.QUERIES)


def queries() -> dict[str, Query]:
    return {**reference_queries(), **_optional()[0]}


def oracle_sql() -> dict[str, str]:
    return {**QUERIES, **_optional()[1]}
