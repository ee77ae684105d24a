"""A third of all rows on one key, checked against plain Python sums."""

from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from finloom.functions.columns import conform
from finloom.layer import Layer
from finloom.operators.clean import dedup
from finloom.operators.cube import payroll_branch
from finloom.operators.kpis import KPIS
from finloom.operators.quality import duplicate_keys, orphans
from finloom.schemas import MART
from finloom.scratch import fresh_schema
from finloom.sinks.tables import overwrite_table
from plans import plan

N = 30_000


@pytest.fixture(scope="module")
def hot(spark):
    """Employee 0, company 1 and ledger key 0 hold a third of the rows."""
    keyed = spark.range(N).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 997 END AS k")
    pay = keyed.selectExpr(
        "id AS payroll_id", "k AS employee_id", "CAST(k % 4 + 1 AS INT) AS company_id",
        "CAST(k % 5 + 1 AS INT) AS department_id", "2024 AS fiscal_year", "CAST(id % 12 + 1 AS INT) AS fiscal_period",
        "CAST(id % 1000 AS DECIMAL(18,2)) AS total_compensation", "CAST(id % 100 AS DECIMAL(18,2)) AS gross_salary",
    )
    people = spark.range(997).selectExpr(
        "id AS employee_id", "CASE WHEN id % 2 = 0 THEN 'Senior' ELSE 'Junior' END AS position"
    )
    companies = spark.range(1, 5).selectExpr("CAST(id AS INT) AS company_id", "concat('C', id) AS company_name")
    departments = spark.range(1, 6).selectExpr(
        "CAST(id AS INT) AS department_id", "concat('D', id) AS department_name", "'x' AS cost_center"
    )

    tables = {"fact_payroll": pay, "dim_employee": people, "dim_company": companies, "dim_departments": departments}
    frames = {name: conform(df, MART[name]) for name, df in tables.items()}
    return Layer({name: lambda df=df: df for name, df in frames.items()})


def rows():
    for i in range(N):
        k = 0 if i % 3 == 0 else i % 997
        yield i, k


def test_hot_employee_average(hot):
    sums, counts, heads = defaultdict(int), defaultdict(int), defaultdict(set)
    for i, k in rows():
        key = (k % 4 + 1, "Senior" if k % 2 == 0 else "Junior")
        sums[key] += i % 1000
        counts[key] += 1
        heads[key].add(k)
    found = {
        (r["company_id"], r["position"]): (r["employee_count"], r["avg_total_compensation"])
        for r in KPIS["kpi5_avg_compensation_by_position"].build(hot).collect()
    }
    assert found == {k: (len(heads[k]), (Decimal(sums[k]) / counts[k]).quantize(Decimal("0.01"))) for k in sums}


def test_hot_department_cost(hot):
    sums, heads = defaultdict(int), defaultdict(set)
    for i, k in rows():
        sums[k % 4 + 1, k % 5 + 1] += i % 1000
        heads[k % 4 + 1, k % 5 + 1].add(k)
    found = {
        (r["company_id"], r["department_id"]): (r["total_compensation_cost"], r["employee_count"])
        for r in KPIS["kpi8_cost_per_department"].build(hot).collect()
    }
    assert found == {k: (Decimal(sums[k]), len(heads[k])) for k in sums}


def test_hot_employee_join_is_split_and_keeps_every_row(spark, hot):
    """The workforce join without broadcast: the hot employee's partition is read by several tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        built = payroll_branch(hot, ["transaction_id", "employee_id", "employee_position"])
        rows_out = built.collect()
        text = plan(built)
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert "SortMergeJoin(skew=true)" in text
    expected = {i: (k, "Senior" if k % 2 == 0 else "Junior") for i, k in rows()}
    assert len(rows_out) == N
    assert {r["transaction_id"]: (r["employee_id"], r["employee_position"]) for r in rows_out} == expected


def test_hot_key_dedup(spark):
    df = spark.range(N).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 997 END AS k", "id AS v", "CAST(id % 2 AS STRING) AS t"
    )
    expected = defaultdict(int)
    for i, k in rows():
        expected[k] = max(expected[k], i)
    assert {r["k"]: r["v"] for r in dedup(df, "k", ["v"]).collect()} == dict(expected)
    assert duplicate_keys(df, "k").filter("k = 0").first()["n_rows"] == sum(1 for _, k in rows() if k == 0)


def test_hot_orphan(spark):
    fact = spark.range(N).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id % 10 END AS k")
    dim = spark.range(10).withColumnRenamed("id", "k")
    assert [tuple(r) for r in orphans(fact, "f", {"k": dim}).collect()] == [("f", "k", "-1", N // 3)]


def test_hot_partition_is_written_by_several_tasks(spark):
    """One year and company with a third of the rows becomes several files, none of the rows is lost."""
    wide = spark.range(N).selectExpr(
        "id", "sha2(CAST(id AS STRING), 512) AS text", "CASE WHEN id % 3 = 0 THEN 2024 ELSE 1900 + id % 50 END AS y"
    )
    table = f"{fresh_schema(spark, 'hot')}.t"
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        overwrite_table(wide, table, partition_by=["y"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    stored = spark.table(table)
    assert stored.count() == N
    files = stored.filter("y = 2024").select(F.col("_metadata.file_path")).distinct().count()
    assert files > 3


def test_null_keys_are_no_orphans(spark):
    fact = spark.createDataFrame([(None, 1), (1, None), (None, None)], "a int, b int")
    nothing = spark.createDataFrame([], "a int, b int")
    found = {tuple(r)[1:] for r in orphans(fact, "f", {"a": nothing, "b": nothing}).collect()}
    assert found == {("a", "1", 1), ("b", "1", 1)}
