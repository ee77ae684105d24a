"""What runs again, late or in part: versions, increments, upserts, one year of a rollup, bitmaps, counts in passing."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from finloom.layer import Layer
from finloom.operators import quality
from finloom.operators.clean import dedup, rejects
from finloom.operators.headcount import YEAR, headcount, monthly_bitmaps
from finloom.operators.kpis import ROLLUP, gl_monthly, net_profit_of
from finloom.operators.mart import FACT_PARTITIONS
from finloom.plans import pipeline
from finloom.schemas import CLEAN, KEYS, MANIFEST, MART, RAW
from finloom.scratch import fresh_folder, fresh_schema
from finloom.sinks.tables import overwrite_table, quoted, replace_partitions
from finloom.sinks.upsert import RANGE, create_keyed, upsert
from finloom.sinks.versions import adopt, current_version, replace_table, roll_back, versions
from finloom.sources.files import AUDIT_COLUMNS, ingest_increment
from finloom.sources.samples import raw_layer
from plans import plan


def files_of(spark, table, where="true"):
    return {r[0] for r in spark.table(table).filter(where).select("_metadata.file_path").distinct().collect()}


# --- versions ---------------------------------------------------------------------------------------------------------


def test_failed_replacement_leaves_the_old_rows(spark):
    table = f"{fresh_schema(spark, 'v')}.t"
    replace_table(spark.range(100), table)
    held, before = spark.table(table), versions(spark, table)
    failing = spark.range(0, 200, 1, 4).filter(F.expr("assert_true(id < 150) IS NULL"))
    with pytest.raises(Exception, match="USER_RAISED"):
        replace_table(failing, table)
    assert versions(spark, table) == before
    assert spark.table(table).count() == held.count() == 100


def test_replacement_reads_what_it_replaces(spark):
    table = f"{fresh_schema(spark, 'v')}.t"
    replace_table(spark.range(10), table)
    for n in (11, 12, 13):
        replace_table(spark.table(table).union(spark.range(n - 1, n)), table)
        assert spark.table(table).count() == n
    assert len(versions(spark, table)) == 2
    roll_back(spark, table)
    assert spark.table(table).count() == 12
    with pytest.raises(ValueError, match="no version"):
        roll_back(spark, table)
    replace_table(spark.range(3), table)  # after going back: the shown version stays until it is replaced
    assert spark.table(table).count() == 3
    assert current_version(spark, table) == versions(spark, table)[-1]


def test_other_columns_and_partitions(spark):
    table = f"{fresh_schema(spark, 'v')}.t"
    replace_table(spark.range(10), table)
    replace_table(spark.range(6).selectExpr("id AS k", "CAST(id % 2 AS INT) AS p"), table, partition_by=["p"])
    assert spark.table(table).columns == ["k", "p"]
    assert "PartitionFilters: [isnotnull(p" in plan(spark.table(table).filter("p = 1"))


def test_a_plain_table_is_refused_until_adopted(spark):
    table = f"{fresh_schema(spark, 'v')}.t"
    overwrite_table(spark.range(5), table)
    with pytest.raises(ValueError, match="adopt"):
        replace_table(spark.range(6), table)
    adopt(spark, table)
    assert spark.table(table).count() == 5
    replace_table(spark.range(6), table)
    assert spark.table(table).count() == 6


def test_versioned_kpis(spark, mart):
    schema = fresh_schema(spark, "v")
    for _ in range(2):
        status = pipeline.materialize_kpis(spark, mart, schema, ["kpi9_headcount_by_department"], versioned=True).collect()
    assert status[0]["n_rows"] == spark.table(f"{schema}.kpi9_headcount_by_department").count() > 0
    assert len(versions(spark, f"{schema}.kpi9_headcount_by_department")) == 2


def test_names_with_a_catalog(spark):
    schema = fresh_schema(spark, "q")
    assert quoted(f"spark_catalog.{schema}.t") == f"`spark_catalog`.`{schema}`.`t`"
    table = f"spark_catalog.{schema}.t"
    overwrite_table(spark.range(4).withColumn("p", F.col("id") % 2), table, partition_by=["p"])
    replace_partitions(spark.range(9).withColumn("p", F.lit(1).cast("bigint")), table, {"p": 1})
    assert spark.table(table).count() == 2 + 9
    replace_table(spark.range(4), f"spark_catalog.{schema}.v")
    assert spark.table(f"spark_catalog.{schema}.v").count() == 4


# --- landing in increments --------------------------------------------------------------------------------------------


@pytest.fixture
def landing(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()

    def land(name, *lines):
        (folder / name).write_text("\n".join(["department_id,department_code,department_name,cost_center", *lines]) + "\n")

    state, prefix = fresh_folder(spark, "state"), fresh_schema(spark, "inc") + "_"

    def run(batch, *names):
        control = spark.createDataFrame([(n, "raw", "departments") for n in names], MANIFEST)
        (table,) = ingest_increment(spark, control, str(folder), batch, state, prefix)
        return spark.table(table), spark.table(f"{table}_rejects")

    return land, run


def test_increments_add_up(landing):
    land, run = landing
    land("a.csv", "1,A,Sales,x", "2,B,HR,y")
    land("b [1].csv", "3,C,IT,z", "4,D", "5,E,Ops,w,extra")
    good, bad = run("b1", "a")
    assert good.count() == 2 and bad.count() == 0
    good, bad = run("b2", "a", "b [1]")
    assert good.columns == [*RAW["departments"].names, *AUDIT_COLUMNS]
    assert Counter(r["_batch_id"] for r in good.collect()) == {"b1": 2, "b2": 1}
    assert {r["_malformed"] for r in bad.collect()} == {"4,D", "5,E,Ops,w,extra"}
    again, bad = run("b3", "a", "b [1]")
    assert again.count() == 3 and bad.count() == 2
    assert {r["_source_file"] for r in again.collect()} >= {"a.csv"}


def test_a_landing_without_lines(landing):
    land, run = landing
    land("a.csv")
    good, bad = run("b1", "a")
    assert good.columns == [*RAW["departments"].names, *AUDIT_COLUMNS] and good.count() == bad.count() == 0
    land("b.csv", "1,A,Sales,x")
    assert run("b2", "a", "b")[0].count() == 1


# --- upsert -----------------------------------------------------------------------------------------------------------


def test_upsert_equals_one_dedup_and_leaves_other_files(spark):
    def lines(a, b, version):
        return spark.range(a, b).selectExpr("id AS k", f"{version} AS v", "concat('t', id % 3) AS t")

    table = f"{fresh_schema(spark, 'u')}.t"
    first, late = lines(0, 1000, 1).union(lines(0, 500, 0)), lines(250, 320, 2).union(lines(990, 1005, 0))
    create_keyed(first, table, "k", 100, ["v"])
    before = {r: files_of(spark, table, f"{RANGE} = {r}") for r in range(10)}
    assert upsert(late, table, "k", ["v"]) == [2, 3, 9, 10]
    expected = dedup(first.union(late), "k", ["v"])
    assert Counter(map(tuple, spark.table(table).drop(RANGE).collect())) == Counter(map(tuple, expected.collect()))
    after = {r: files_of(spark, table, f"{RANGE} = {r}") for r in range(10)}
    assert {r for r in range(10) if before[r] != after[r]} == {2, 3, 9}
    rows = Counter(map(tuple, spark.table(table).collect()))
    upsert(late, table, "k", ["v"])
    assert Counter(map(tuple, spark.table(table).collect())) == rows


def test_upsert_of_nothing_and_of_null_keys(spark):
    kind = "k bigint, v int"
    table = f"{fresh_schema(spark, 'u')}.t"
    create_keyed(spark.createDataFrame([(1, 1), (None, 7), (None, 7)], kind), table, "k", 10, ["v"])
    assert upsert(spark.createDataFrame([], kind), table, "k", ["v"]) == []
    assert upsert(spark.createDataFrame([(None, 8), (-3, 2)], kind), table, "k", ["v"]) == [None, -1]
    found = Counter((r["k"], r["v"]) for r in spark.table(table).collect())
    assert found == {(1, 1): 1, (None, 7): 2, (None, 8): 1, (-3, 2): 1}


# --- one year of the rollup -------------------------------------------------------------------------------------------


def test_one_year_of_the_rollup(spark, mart):
    """After a year is replaced, the KPIs equal a full rebuild, and only that year of the ledger is read."""
    schema, name = fresh_schema(spark, "y"), "kpi3_gross_profit_margin"
    table = f"{schema}.fact_gl"
    overwrite_table(mart["fact_gl"], table, partition_by=FACT_PARTITIONS)

    def stored():
        return Layer({**{n: lambda n=n: mart[n] for n in MART}, "fact_gl": lambda: spark.table(table)})

    pipeline.materialize_kpis(spark, stored(), schema, [name])
    kept = files_of(spark, f"{schema}.{ROLLUP}", "fiscal_year <> 1995")
    replace_partitions(mart["fact_gl"].filter("company_id = 2"), table, {"fiscal_year": 1995})
    pipeline.materialize_kpis(spark, stored(), schema, [name], year=1995)
    whole = fresh_schema(spark, "whole")
    pipeline.materialize_kpis(spark, stored(), whole, [name])
    rows = [Counter(map(tuple, spark.table(f"{s}.{name}").collect())) for s in (schema, whole)]
    assert rows[0] == rows[1] and rows[0]
    assert files_of(spark, f"{schema}.{ROLLUP}", "fiscal_year <> 1995") == kept
    text = plan(gl_monthly(spark.table(table).filter(F.col("fiscal_year") == 1995)), "formatted")
    assert "PartitionFilters: [isnotnull(fiscal_year" in text


def test_a_condition_on_companies_prunes_the_ledger(spark, mart):
    table = f"{fresh_schema(spark, 'dpp')}.fact_gl"
    overwrite_table(mart["fact_gl"], table, partition_by=FACT_PARTITIONS)
    stored = Layer({**{n: lambda n=n: mart[n] for n in MART}, "fact_gl": lambda: spark.table(table)})
    text = plan(net_profit_of(stored, "country = 'C1'"))
    assert "dynamicpruning" in text


# --- bitmaps ----------------------------------------------------------------------------------------------------------


def test_bitmaps_count_each_employee_once(spark):
    """A third of the rows on one employee, numbers over many buckets and below zero, and rows without a number."""
    ids = "CASE WHEN id % 3 = 0 THEN 5 WHEN id % 11 = 0 THEN NULL ELSE (id * 7919) % 200000 - 1000 END"
    pay = spark.range(30_000).selectExpr(
        f"{ids} AS employee_id", "CAST(2020 + id % 2 AS INT) AS fiscal_year",
        "CAST(id % 12 + 1 AS INT) AS fiscal_period", "CAST(id % 5 AS INT) AS company_id",
    )
    bitmaps = monthly_bitmaps(pay)
    found = {tuple(r) for r in headcount(bitmaps, YEAR, "company_id").collect()}
    expected = pay.groupBy("fiscal_year", "company_id").agg(F.countDistinct("employee_id").alias("n")).collect()
    assert found == {(r[0], None, r[1], r["n"]) for r in expected}


# --- counts in passing, hot keys --------------------------------------------------------------------------------------


def test_observed_counts_equal_the_scan(spark, small):
    raw = raw_layer(spark, small)["payroll"]
    observed = quality.ObservedNulls(raw, CLEAN["payroll"], "payroll")
    overwrite_table(observed.rows, f"{fresh_schema(spark, 'o')}.t")
    expected = quality.null_counts(raw, CLEAN["payroll"], "payroll").collect()
    assert Counter(map(tuple, quality.observed_counts(spark, [observed]).collect())) == Counter(map(tuple, expected))


def test_rejects_and_reconcile_with_a_hot_key(spark):
    """A third of the rows on one key, exact copies among them: rejects and kept rows are all rows, in one scan."""
    n = 30_000
    hot = "CASE WHEN id % 3 = 0 THEN '1' WHEN id % 100 = 1 THEN NULL ELSE CAST(id % 5000 AS STRING) END"
    clean = spark.range(n).selectExpr(
        *(f"CAST({hot} AS BIGINT) AS gl_id" if f.name == "gl_id"
          else "date_add(DATE'2024-01-01', CAST(id % 40 AS INT)) AS posting_date" if f.name == "posting_date"
          else "CASE WHEN id % 2 = 0 THEN 'Posted' ELSE 'Draft' END AS status" if f.name == "status"
          else f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in CLEAN["general_ledgers"].fields)
    )
    out = rejects(clean, "general_ledgers")
    kept = dedup(clean.filter("gl_id IS NOT NULL"), "gl_id", ("posting_date", "entry_date"))
    every = Counter(map(tuple, clean.collect()))
    assert Counter(map(tuple, out.drop("reject_reason").collect())) + Counter(map(tuple, kept.collect())) == every
    assert kept.count() == len({k[0] for k in every if k[0] is not None})
    assert plan(out, "simple").count("Range (") == 1
    fact = kept.filter("status = 'Posted'")
    row = quality.reconcile("general_ledgers", clean, KEYS["general_ledgers"], "status = 'Posted'", fact).first()
    assert row["balanced"] and row["n_raw"] == n and row["n_kept"] == kept.count()
    assert row["n_fact"] + row["n_excluded"] == row["n_kept"]


def test_dedup_reads_the_table_once(spark, small):
    raw = raw_layer(spark, small)["general_ledgers"]
    text = plan(dedup(raw, "gl_id"), "simple")
    assert text.count("FileScan") == 1 and "WindowGroupLimit" in text
