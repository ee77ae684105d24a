"""Every registered query against its DuckDB restatement, value by value."""

import pytest

import __spark_entry__ as registry
from compare import connect, difference
from finloom.operators.kpis import KPIS
from finloom.schemas import MART
from oracle.sql import QUERIES

SMALL_CHECKED = sorted(registry.reference_queries())
MEDIUM_CHECKED = [*KPIS, *MART, "datacube_profile", "datacube_sample", "dq_orphans", "dq_reconcile", "clean_gl_dedup"]


# The DuckDB name of each Spark type in use; decimals go by the same name in both.
SQL_TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "date": "DATE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def small_sql(small):
    return connect(small)


@pytest.fixture(scope="module")
def medium_sql(medium):
    return connect(medium)


def test_every_query_has_a_check():
    assert set(SMALL_CHECKED) == set(QUERIES)


@pytest.mark.parametrize("name", SMALL_CHECKED)
def test_small(spark, small, small_sql, name):
    result, sql = registry.queries()[name](spark, small), registry.oracle_sql()[name]
    assert difference(result, small_sql, sql) is None
    described = {row[0]: row[1] for row in small_sql.execute(f"DESCRIBE {sql}").fetchall()}
    assert {c: SQL_TYPES.get(t, t.upper()) for c, t in result.dtypes} == described


@pytest.mark.parametrize("name", MEDIUM_CHECKED)
def test_medium(spark, medium, medium_sql, name):
    assert difference(registry.queries()[name](spark, medium), medium_sql, registry.oracle_sql()[name]) is None


def test_entry(spark):
    result = registry.entry(spark)
    assert result.columns[:4] == ["fiscal_year", "fiscal_period", "fiscal_month_label", "company_id"]
    assert result.count() > 0
