"""Stored layers, sinks and views."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from compare import connect, difference
from finloom import scratch
from finloom.config import Layout
from finloom.operators.kpis import KPIS, ROLLUP, gl_monthly
from finloom.operators.mart import FACT_PARTITIONS
from finloom.plans import pipeline
from finloom.plans.layers import mart_of, silver_of
from finloom.schemas import CLEAN, CUBE, MART, RAW, SILVER
from finloom.scratch import fresh_schema
from finloom.sinks.tables import overwrite_table, replace_partitions
from finloom.sources import files
from finloom.sources.samples import manifest, raw_layer
from oracle.sql import QUERIES
from plans import plan


@pytest.fixture(scope="module")
def stored(spark, small, tmp_path_factory):
    """The whole pipeline, run once: landed CSV files, manifest ingest, every layer, KPIs, views, cube."""
    layout, landing = Layout().prefixed("t_"), tmp_path_factory.mktemp("landing")
    for name, df in raw_layer(spark, small).items():
        df.write.option("header", True).csv(str(landing / name))
    files.ingest(spark, manifest(spark), str(landing), "batch-1", schema_prefix="t_bronze_")
    status = pipeline.run(spark, layout)
    return layout, {r["kpi"]: (r["table_name"], r["n_rows"]) for r in status.collect()}


def test_status_names_every_kpi(spark, stored):
    layout, status = stored
    assert list(status) == list(KPIS)
    for name, (table, n) in status.items():
        assert table == f"{layout.mart}.{name}"
        assert spark.table(table).count() == n > 0


@pytest.mark.parametrize("name", KPIS)
def test_stored_kpi_equals_check(spark, stored, small, name):
    layout, _ = stored
    assert difference(spark.table(f"{layout.mart}.{name}"), connect(small), QUERIES[name]) is None
    assert difference(spark.table(f"{layout.curated}.{KPIS[name].view}"), connect(small), QUERIES[name]) is None


def test_stored_cube_equals_check(spark, stored, small):
    cube = pipeline.stored_cube(spark, stored[0])  # partition columns come last in the table
    assert cube.schema.simpleString() == CUBE.simpleString()
    assert difference(cube, connect(small), QUERIES["fact_integrated_datacube"]) is None


@pytest.mark.parametrize("layer", ["raw", "clean", "silver"])
def test_stored_schemas(spark, stored, layer):
    declared = {"raw": RAW, "clean": CLEAN, "silver": SILVER}[layer]
    for name, schema in declared.items():
        table = spark.table(f"{getattr(stored[0], layer)}.{name}").drop(*files.AUDIT_COLUMNS)
        assert table.schema.simpleString() == schema.simpleString()


def test_mart_schemas(spark, stored, mart):
    tables = pipeline.stored_mart(spark, stored[0])
    for name, schema in MART.items():
        assert tables[name].schema.simpleString() == schema.simpleString()
        assert mart[name].schema.simpleString() == schema.simpleString()


def test_lazy_layer_schemas(spark, small):
    silver = silver_of(raw_layer(spark, small))
    for name, schema in SILVER.items():
        assert silver[name].schema.simpleString() == schema.simpleString()


def test_rerun_gives_the_same_rows(spark, stored):
    layout, status = stored
    again = {r["kpi"]: (r["table_name"], r["n_rows"]) for r in pipeline.run(spark, layout).collect()}
    assert again == status


def test_facts_are_partitioned_and_pruned(spark, stored):
    for fact in ("fact_gl", "fact_payroll"):
        table = f"{stored[0].mart}.{fact}"
        assert [c.name for c in spark.catalog.listColumns(table) if c.isPartition] == list(FACT_PARTITIONS)
        text = plan(spark.table(table).filter("fiscal_year = 1998"), "formatted")
        assert "PartitionFilters: [isnotnull(fiscal_year" in text


def test_one_year_can_be_replaced(spark, mart):
    table = f"{fresh_schema(spark, 'rerun')}.fact_gl"
    overwrite_table(mart["fact_gl"], table, partition_by=FACT_PARTITIONS)
    before = {r["fiscal_year"]: r["count"] for r in spark.table(table).groupBy("fiscal_year").count().collect()}
    replace_partitions(mart["fact_gl"].filter("fiscal_year = 1998").limit(3), table, {"fiscal_year": 1998})
    after = {r["fiscal_year"]: r["count"] for r in spark.table(table).groupBy("fiscal_year").count().collect()}
    assert {y: n for y, n in after.items() if y != 1998} == {y: n for y, n in before.items() if y != 1998}
    assert after[1998] == 3 < before[1998]
    with pytest.raises(ValueError, match="partitioned"):
        replace_partitions(mart["fact_gl"], table, {"company_id": 1})


def test_year_rerun_changes_nothing_if_the_raw_tables_did_not(spark, stored):
    layout, status = stored
    tables = [f"{layout.mart}.fact_gl", f"{layout.mart}.fact_payroll", f"{layout.datacube}.{pipeline.CUBE_TABLE}"]
    before = [spark.table(t).selectExpr("count(*)", "sum(CAST(xxhash64(*) AS DECIMAL(20)))").first() for t in tables]
    again = pipeline.rerun_year(spark, layout, 1998)
    assert {r["kpi"]: (r["table_name"], r["n_rows"]) for r in again.collect()} == status
    for t in tables:
        spark.catalog.refreshTable(t)
    assert [spark.table(t).selectExpr("count(*)", "sum(CAST(xxhash64(*) AS DECIMAL(20)))").first() for t in tables] == before
    parts = [c.name for c in spark.catalog.listColumns(tables[2]) if c.isPartition]
    assert parts == list(pipeline.CUBE_PARTITIONS)


def test_scratch_schemas_can_be_dropped(spark):
    name = fresh_schema(spark, "gone")
    spark.range(3).write.saveAsTable(f"{name}.t")
    own = dict(scratch._schemas)
    scratch._schemas[spark.sparkContext.applicationId] = [name]
    scratch.drop_scratch(spark)
    scratch._schemas.update(own)
    assert not spark.catalog.databaseExists(name)


def test_session_views(spark, mart):
    pipeline.register_session_views(mart)
    n = spark.sql("SELECT count(*) FROM fact_general_ledger WHERE pl_section = 'Revenue'").first()[0]
    assert n == mart["fact_gl"].filter("pl_section = 'Revenue'").count()
    for name, kpi in KPIS.items():
        assert spark.table(kpi.view).columns == KPIS[name].build(mart).columns


def test_invariants(mart):
    frames = {name.split("_")[0]: kpi.build(mart) for name, kpi in KPIS.items()}

    def total(frame, column):
        return frames[frame].agg(F.sum(column)).first()[0]

    assert total("kpi1", "total_revenue") == total("kpi3", "revenue") == total("kpi6", "revenue")
    assert total("kpi2", "cost_of_sales") == total("kpi6", "cogs")
    assert total("kpi4", "opex_amount") == total("kpi6", "operating_expenses")
    assert total("kpi3", "gross_profit") == total("kpi6", "gross_profit")
    keys = ["fiscal_year", "fiscal_period", "company_id"]
    both = frames["kpi3"].select(*keys, F.col("gross_profit").alias("g3")).join(frames["kpi6"], keys)
    assert both.count() == frames["kpi3"].count()
    assert both.filter("g3 <> gross_profit").count() == 0


def test_rollup_sums_are_the_fact_sums(mart):
    rollup = gl_monthly(mart["fact_gl"]).agg(F.sum("debits"), F.sum("credits")).first()
    fact = mart["fact_gl"].agg(F.sum("debit_amount"), F.sum("credit_amount")).first()
    assert tuple(rollup) == tuple(fact)


def test_tables_nobody_asks_for_are_not_read(spark, tmp_path):
    broken = mart_of(raw_layer(spark, str(tmp_path)))
    assert set(broken) == set(MART)
    with pytest.raises(Exception):  # noqa: B017
        broken["dim_company"]


def test_one_row_per_key_run(spark, stored, small):
    """With key cleaning on, the ledger fact has unique keys and the KPI tables are rebuilt from it."""
    layout = replace(Layout().prefixed("u_"), raw=stored[0].raw)
    pipeline.run(spark, layout, one_row_per_key=True)
    fact = spark.table(f"{layout.mart}.fact_gl")
    assert fact.count() == fact.select("gl_id").distinct().count()
    expected = connect(small).execute(f"select count(*) from ({QUERIES['clean_gl_dedup']}) where gl_id is not null").fetchall()[0][0]
    assert spark.table(f"{layout.silver}.general_ledgers").count() == expected


def test_rollup_is_stored_for_ledger_kpis_only(spark, mart):
    for name in ("kpi9_headcount_by_department", "kpi2_cost_of_sales_by_month"):
        schema = fresh_schema(spark, "some")
        status = pipeline.materialize_kpis(spark, mart, schema, [name]).collect()
        assert [r["kpi"] for r in status] == [name]
        assert spark.catalog.tableExists(f"{schema}.{ROLLUP}") == KPIS[name].of_ledger
