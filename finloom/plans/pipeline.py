"""Raw tables to KPIs and cube as stored tables, one layer after the other.

Each layer is read back from its tables, so a lost executor costs at most the running layer, and every KPI
reads a stored fact instead of the whole chain.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.config import Layout
from finloom.layer import Layer
from finloom.operators import quality
from finloom.operators.clean import clean_layer, rejects_layer
from finloom.operators.cube import GENERAL_LEDGER, PAYROLL, gl_branch, integrated_cube, payroll_branch
from finloom.operators.kpis import KPIS, ROLLUP, gl_monthly
from finloom.operators.mart import FACT_PARTITIONS, mart_layer
from finloom.operators.silver import silver_layer
from finloom.schemas import CLEAN, CUBE, KEYS, MART, RAW
from finloom.sinks.tables import (
    ensure_schema,
    overwrite_table,
    publish_temp_views,
    publish_views,
    quoted,
    replace_partitions,
    write_together,
)
from finloom.sinks.versions import replace_table
from finloom.sources.drift import findings, stored_as_declared

CUBE_TABLE = "fact_integrated_datacube"
CUBE_PARTITIONS = ("source_fact", "fiscal_year")


def store(spark: SparkSession, layer: Layer, schema: str, table_format: str = "parquet") -> Layer:
    """Write every table of a layer and hand back the stored ones."""
    ensure_schema(spark, schema)
    writes = [partial(overwrite_table, df, f"{schema}.{name}", table_format) for name, df in layer.items()]
    write_together(spark, writes)
    return Layer.stored(spark, schema, layer)


def stored_mart(spark: SparkSession, layout: Layout) -> Layer:
    """The stored star schema, columns in declared order (a partitioned table lists its partition columns last)."""
    tables = Layer.stored(spark, layout.mart, MART)
    return Layer({name: lambda name=name: tables[name].select(*MART[name].names) for name in MART})


def store_clean(spark: SparkSession, raw: Layer, layout: Layout, one_row_per_key: bool = False) -> Layer:
    """The clean tables, with their null counts taken in passing as ``dq_null_counts``."""
    observed = {n: quality.ObservedNulls(raw[n], CLEAN[n], n) for n in CLEAN}
    watched = Layer({n: lambda n=n: observed[n].rows for n in CLEAN})
    clean = store(spark, clean_layer(watched, one_row_per_key), layout.clean, layout.table_format)
    counts = quality.observed_counts(spark, observed.values())
    overwrite_table(counts, f"{layout.clean}.dq_null_counts", layout.table_format)
    return clean


def store_drift(spark: SparkSession, layout: Layout) -> None:
    """Where the stored raw tables differ from the declared ones, as ``dq_schema_drift``; raises `SchemaDrift` if a column
    cannot be read as declared."""
    ensure_schema(spark, layout.clean)
    found = findings(spark, Layer.stored(spark, layout.raw, RAW), RAW)
    overwrite_table(found, f"{layout.clean}.dq_schema_drift", layout.table_format)


def build_mart(spark: SparkSession, layout: Layout, one_row_per_key: bool = False) -> Layer:
    """Raw tables -> clean -> silver -> star schema, each layer stored.

    Raw tables whose columns went, came, were renamed or retyped are read as declared where that loses nothing."""
    raw = stored_as_declared(spark, layout.raw, RAW)
    store_drift(spark, layout)
    clean = store_clean(spark, raw, layout, one_row_per_key)
    if one_row_per_key:  # what the clean tables leave out
        store(spark, rejects_layer(raw), layout.clean, layout.table_format)
    silver = store(spark, silver_layer(clean), layout.silver, layout.table_format)
    star = mart_layer(silver)
    dimensions = Layer({n: lambda n=n: star[n] for n in MART if n.startswith("dim_")})
    store(spark, dimensions, layout.mart, layout.table_format)
    check_dimension_keys(stored_mart(spark, layout))
    # the ledger fact joins the account dimension as stored, not as a plan to run again
    star = mart_layer(silver, stored_mart(spark, layout))
    facts = [n for n in MART if n.startswith("fact_")]
    write_together(
        spark,
        [
            partial(overwrite_table, star[n], f"{layout.mart}.{n}", layout.table_format, FACT_PARTITIONS)
            for n in facts
        ],
    )
    return stored_mart(spark, layout)


# The key of each dimension.
DIMENSION_KEYS = {
    "dim_account": "account_id",
    "dim_departments": "department_id",
    "dim_employee": "employee_id",
    "dim_company": "company_id",
}


def check_dimension_keys(mart: Layer) -> None:
    """KPIs and cube join on unique dimension keys; repeated ones stop the run instead of multiplying amounts."""
    found = quality.duplicate_keys_of(mart, DIMENSION_KEYS).filter("key_value IS NOT NULL")
    counts = found.groupBy("table_name").agg(F.expr("count(*) AS n")).collect()  # a row per dimension
    if counts:
        told = ", ".join(f"{r['table_name']}: {r['n']}" for r in counts)
        raise ValueError(f"repeated dimension keys ({told}); run with one_row_per_key=True or mend the source")


def store_quality(spark: SparkSession, layout: Layout) -> None:
    """The key check of the run as a table beside the clean layer; null counts are there since it was written."""
    repeated = quality.duplicate_keys_of(Layer.stored(spark, layout.clean, CLEAN), KEYS)
    overwrite_table(repeated, f"{layout.clean}.dq_duplicate_keys", layout.table_format)


def materialize_kpis(
    spark: SparkSession,
    mart: Layer,
    schema: str,
    names: Iterable[str] = tuple(KPIS),
    table_format: str = "parquet",
    year: int | None = None,
    versioned: bool = False,
) -> DataFrame:
    """Write the KPIs as tables; returns one row per KPI with its table and row count.

    The ledger is aggregated once, into a stored monthly rollup that all ledger KPIs read. With ``year``, only that year
    of the ledger has changed since: its partition of the rollup is replaced, other years are not read again.
    ``versioned`` tables are replaced in one step each.
    """
    replace = replace_table if versioned else overwrite_table
    ensure_schema(spark, schema)
    names = list(names)
    tables_of = {name: lambda name=name: mart[name] for name in MART}
    if any(KPIS[name].of_ledger for name in names):
        rollup = f"{schema}.{ROLLUP}"
        if year is not None and spark.catalog.tableExists(quoted(rollup)):
            of_year = gl_monthly(mart["fact_gl"].filter(F.col("fiscal_year") == year))
            replace_partitions(of_year, rollup, {"fiscal_year": year})
        else:
            overwrite_table(gl_monthly(mart["fact_gl"]), rollup, table_format, ["fiscal_year"])
        tables_of[ROLLUP] = lambda: spark.table(quoted(rollup))
    shared = Layer(tables_of)
    tables = {name: f"{schema}.{name}" for name in names}
    built = {name: KPIS[name].build(shared) for name in names}
    writes = [partial(replace, built[name], table, table_format) for name, table in tables.items()]
    write_together(spark, writes)
    counts = [
        spark.table(quoted(table))
        .agg(F.expr("count(*) AS n_rows"))
        .selectExpr(f"'{name}' AS kpi", f"'{table}' AS table_name", "n_rows")
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def publish_kpi_views(
    spark: SparkSession, kpi_schema: str, view_schema: str, names: Iterable[str] = tuple(KPIS)
) -> None:
    """Persistent views over the KPI tables."""
    publish_views(spark, view_schema, {KPIS[name].view: f"{kpi_schema}.{name}" for name in names})


def register_session_views(mart: Layer) -> None:
    """Session views of the star schema and of every KPI."""
    # The ledger fact goes by a longer name in SQL.
    inputs = {("fact_general_ledger" if name == "fact_gl" else name): mart[name] for name in MART}
    publish_temp_views({**inputs, **{kpi.view: kpi.build(mart) for kpi in KPIS.values()}})


def stored_cube(spark: SparkSession, layout: Layout) -> DataFrame:
    """The stored cube, columns in declared order."""
    return spark.table(quoted(f"{layout.datacube}.{CUBE_TABLE}")).select(*CUBE.names)


def build_cube(spark: SparkSession, mart: Layer, layout: Layout) -> DataFrame:
    """Store the integrated cube, by source and year."""
    ensure_schema(spark, layout.datacube)
    table = f"{layout.datacube}.{CUBE_TABLE}"
    overwrite_table(integrated_cube(mart), table, layout.table_format, CUBE_PARTITIONS)
    return stored_cube(spark, layout)


def rerun_year(spark: SparkSession, layout: Layout, year: int, one_row_per_key: bool = False) -> DataFrame:
    """One fiscal year again, from the raw tables as they are now, against the stored dimensions: its partitions of
    both facts and of the cube are replaced, other years' files stay; then the KPIs are stored anew."""
    silver = silver_layer(clean_layer(stored_as_declared(spark, layout.raw, RAW), one_row_per_key))
    fresh = mart_layer(silver, stored_mart(spark, layout))
    facts = [n for n in MART if n.startswith("fact_")]
    for n in facts:
        replace_partitions(fresh[n], f"{layout.mart}.{n}", {"fiscal_year": year})
    mart = stored_mart(spark, layout)
    cube = f"{layout.datacube}.{CUBE_TABLE}"
    for source, branch in ((PAYROLL, payroll_branch), (GENERAL_LEDGER, gl_branch)):
        replace_partitions(branch(mart), cube, {"source_fact": source, "fiscal_year": year})
    return materialize_kpis(
        spark, mart, layout.mart, table_format=layout.table_format, year=year, versioned=layout.versioned
    )


def run(spark: SparkSession, layout: Layout = Layout(), one_row_per_key: bool = False) -> DataFrame:  # noqa: B008
    """The whole pipeline over stored raw tables; returns the KPI status rows."""
    mart = build_mart(spark, layout, one_row_per_key)
    status = materialize_kpis(spark, mart, layout.mart, table_format=layout.table_format, versioned=layout.versioned)
    publish_kpi_views(spark, layout.mart, layout.curated)
    build_cube(spark, mart, layout)
    store_quality(spark, layout)
    return status
