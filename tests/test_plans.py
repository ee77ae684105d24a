"""The physical plans the queries rely on at scale."""

import re

import pytest

import __spark_entry__ as registry
from finloom.functions import joins
from finloom.operators.kpis import KPIS
from plans import plan

LEDGER_KPIS = [n for n in KPIS if n.split("_")[0] in ("kpi1", "kpi2", "kpi3", "kpi4", "kpi6")]


@pytest.mark.parametrize("name", sorted(set(registry.reference_queries()) - {"ingest_manifest"}))
def test_no_cross_join(spark, small, name):
    text = plan(registry.queries()[name](spark, small), "extended")
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", LEDGER_KPIS)
def test_ledger_kpi_moves_aggregates_only(spark, mart, name):
    """No exchange below the first partial aggregate of the ledger: facts are reduced where they are read."""
    text = plan(KPIS[name].build(mart))
    scan = next(i for i, row in enumerate(text.splitlines()) if "lineitem" in row)
    above = [row for row in text.splitlines()[:scan]]
    first = max(i for i, row in enumerate(above) if "Exchange" in row)
    below_exchange = "\n".join(text.splitlines()[first + 1 : scan])
    assert "partial_sum" in below_exchange
    assert "BroadcastHashJoin" in below_exchange


def test_only_needed_columns_are_read(mart):
    text = plan(KPIS["kpi6_net_profit_by_month"].build(mart), "formatted")
    schema = re.search(r"ReadSchema: struct<([^>]*l_shipdate[^>]*)>", text).group(1)
    read = {c.split(":")[0] for c in schema.split(",")}
    assert read == {"l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"}


def test_profile_joins_no_employees(spark, small):
    text = plan(registry.queries()["datacube_profile"](spark, small))
    assert "customer" not in text
    assert "Expand" not in text.split("lineitem")[1]


def test_dedup_cuts_groups_before_the_shuffle(spark, small):
    assert "Partial" in plan(registry.queries()["clean_gl_dedup"](spark, small))


def test_window_sees_months_only(mart):
    text = plan(KPIS["kpi1_monthly_consolidated_revenue"].build(mart))
    rows = text.splitlines()
    window = next(i for i, row in enumerate(rows) if "Window" in row)
    assert any("HashAggregate" in row for row in rows[window:])


def test_partition_pruning(spark, small):
    text = plan(registry.queries()["fact_gl_partition_pruned"](spark, small), "formatted")
    assert re.search(r"PartitionFilters: \[.*fiscal_year", text)


@pytest.mark.parametrize("name", ["fact_gl", "datacube_gl", "fact_integrated_datacube", "datacube_sample"])
def test_a_dimension_is_measured_once(spark, small, monkeypatch, name):
    measured = []
    check = joins.is_small
    monkeypatch.setattr("finloom.layer.is_small", lambda df: measured.append(df) or check(df))
    monkeypatch.setattr(joins, "is_small", lambda df: measured.append(df) or check(df))
    registry.queries()[name](spark, small)
    assert len(measured) == 1


def test_orphans_need_no_account_join(spark, small):
    text = plan(registry.queries()["dq_orphans"](spark, small))
    assert len(re.findall(r"FileScan[^\n]*/part\.parquet", text)) == 1


def test_large_dimension_is_not_broadcast(spark, monkeypatch):
    """Beyond the bound the join is a shuffle join with the same rows."""
    fact = spark.range(100).selectExpr("id % 7 AS k", "id AS v")
    dim = spark.range(5).selectExpr("id AS k", "concat('n', id) AS name")
    hinted = joins.lookup(fact, dim, "k")
    monkeypatch.setattr(joins, "is_small", lambda df: False)
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plain = joins.lookup(fact, dim, "k")
        assert "SortMergeJoin" in plan(plain)
        assert sorted(map(tuple, plain.collect()), key=str) == sorted(map(tuple, hinted.collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan(hinted)


def test_size_check_counts_rows_and_bytes(spark):
    df = spark.range(100).selectExpr("id", "repeat('x', 100) AS t")
    assert joins.is_small(df)
    assert not joins.is_small(df, max_rows=99)
    assert not joins.is_small(df, max_bytes=5_000)
    assert joins.is_small(df.filter("false"), max_rows=0, max_bytes=0)
