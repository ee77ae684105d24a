"""Hot keys found by a sketch, tables bucketed by employee, stored tables whose columns drifted."""

from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finloom.config import Layout
from finloom.functions.hot import frequent_keys, hot_keys, is_hot
from finloom.layer import Layer
from finloom.operators.clean import clean_table, rejects
from finloom.operators.cube import payroll_branch, payroll_branch_bucketed
from finloom.operators.kpis import KPIS
from finloom.plans.pipeline import store_drift
from finloom.schemas import CLEAN, RAW
from finloom.scratch import fresh_schema
from finloom.sinks.buckets import MAX_BUCKETS, bucket_count, bucketed, store_bucketed
from finloom.sinks.tables import overwrite_table
from finloom.sources.drift import SchemaDrift, compare, conformed, findings, loses_nothing, stored_as_declared
from finloom.sources.samples import raw_layer
from plans import plan


def counted(df):
    return Counter(map(tuple, df.collect()))


# --- hot keys ---------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """60,000 rows: a third on key 0, a twentieth on -7, a hundredth exactly on 11, no key on a tenth, the rest spread."""
    key = (
        "CASE WHEN id < 20000 THEN 0 WHEN id < 23000 THEN -7 WHEN id < 23600 THEN 11 WHEN id < 29600 THEN NULL "
        "ELSE 1000 + (id * 7919) % 30000 END"
    )
    return spark.range(60_000).selectExpr("id", f"{key} AS k").repartition(16, "id")


@pytest.mark.parametrize("one_in", [2, 5, 20, 100])
def test_sketch_misses_no_key_with_the_share(skewed, one_in):
    counts = Counter(r["k"] for r in skewed.select("k").collect())
    least = {str(k) for k, n in counts.items() if k is not None and n * one_in >= 60_000}
    found = hot_keys(skewed, "k", one_in)
    assert least <= set(found) and len(found) <= 2 * one_in
    assert all(counts[int(k)] * one_in * 2 >= 60_000 for k in found)
    exact = {r["key_value"]: r["n_rows"] for r in frequent_keys(skewed, "t", ["k"], one_in).collect()}
    assert exact == {(None if k is None else str(k)): n for k, n in counts.items() if n * one_in >= 60_000}


def test_sketch_of_nothing(spark, skewed):
    empty = skewed.limit(0)
    assert hot_keys(empty, "k") == [] and frequent_keys(empty, "t", ["k", "id"]).count() == 0
    assert hot_keys(spark.range(50).selectExpr("CAST(NULL AS BIGINT) AS k"), "k") == []
    assert skewed.filter(is_hot("k", [])).count() == 0
    assert skewed.filter(~is_hot("k", ["0"])).count() == 40_000  # rows without a key are not hot
    with pytest.raises(ValueError):
        hot_keys(skewed, "k", 0)


@pytest.fixture(scope="module")
def ledger(spark, skewed):
    """Ledger lines with the skewed keys; many exact copies under the hot ones."""
    made = {"gl_id": "k", "posting_date": "date_add(DATE'2024-01-01', CAST(id % 40 AS INT))", "status": "id % 3"}
    return skewed.selectExpr(
        *(f"CAST({made.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in CLEAN["general_ledgers"])
    )


@pytest.mark.parametrize("hot", [[], ["0"], ["0", "-7", "11"], ["5", "1001"]])
def test_rejects_do_not_depend_on_the_list(ledger, hot):
    assert counted(rejects(ledger, "general_ledgers", hot)) == counted(rejects(ledger, "general_ledgers"))


def test_no_task_ranks_a_hot_key_whole(spark, ledger):
    """With the hot key named, rows of it lie in many partitions of the first ranking, other rows are moved once."""
    named = hot_keys(ledger, "gl_id")
    assert "0" in named
    text = plan(rejects(ledger, "general_ledgers", named))
    cold, parts = text.split("Union", 1)[1].split("_part", 1)[0], text.count("Exchange hashpartitioning(gl_id")
    assert "Exchange" in cold and parts == 3  # one for cold rows, two for hot ones
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        hot = ledger.filter(is_hot("gl_id", ["0"])).withColumn("_part", F.monotonically_increasing_id() % 64)
        dealt = hot.repartition("gl_id", "_part").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    sizes = sorted(r["count"] for r in dealt)
    assert len(sizes) > 12 and sizes[-1] < 20_000 / 4


# --- buckets ----------------------------------------------------------------------------------------------------------


def test_bucket_count():
    assert [bucket_count(n, 10) for n in (0, 1, 10, 11, 20, 21, 90)] == [1, 1, 1, 2, 2, 4, 16]
    assert bucket_count(10**15) == MAX_BUCKETS


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def test_bucketed_join_and_grouping_move_no_payroll(spark, mart, no_broadcast):
    schema = fresh_schema(spark, "b")
    fact = store_bucketed(mart["fact_payroll"], f"{schema}.fact_payroll", "employee_id", 4, hot=())
    people = store_bucketed(mart["dim_employee"], f"{schema}.dim_employee", "employee_id", 4, hot=())
    files = fact.cold.select(F.input_file_name()).distinct().count()
    assert files <= 4
    tables = {name: lambda name=name: mart[name] for name in mart}
    by_employee = Layer({**tables, "fact_payroll": lambda: fact.rows, "dim_employee": lambda: people.cold})
    text = plan(payroll_branch(by_employee, ["transaction_id", "employee_name"], fact.cold))
    assert "SortMergeJoin" in text and "Exchange" not in text and "Bucketed: true" in text
    assert "Exchange" not in plan(fact.cold.groupBy("company_id", "employee_id").count())
    kpi = KPIS["kpi5_avg_compensation_by_position"]
    assert kpi.build(by_employee).collect() == kpi.build(mart).collect()


def test_hot_employee_is_stored_apart(spark, mart, no_broadcast):
    """A third of payroll on one employee, and rows without one: nothing is lost, no bucket holds the hot employee."""
    hot = "CASE WHEN payroll_id % 3 = 0 THEN 4 WHEN payroll_id % 50 = 1 THEN NULL ELSE employee_id END"
    pay = mart["fact_payroll"].withColumn("employee_id", F.expr(f"CAST({hot} AS BIGINT)"))
    schema = fresh_schema(spark, "b")
    fact = store_bucketed(pay, f"{schema}.fact_payroll", "employee_id", 16)
    people = store_bucketed(mart["dim_employee"], f"{schema}.dim_employee", "employee_id", 16, hot=())
    assert fact.hot_keys == ("4",) and fact.cold.filter("employee_id = 4 OR employee_id IS NULL").count() == 0
    assert counted(fact.rows) == counted(pay)
    out = payroll_branch_bucketed(mart, fact, people)
    assert counted(out) == counted(payroll_branch(mart, fact=pay))
    text = plan(payroll_branch_bucketed(mart, fact, people, ["transaction_id", "employee_name"]))
    assert "Exchange hashpartitioning" not in text and "BroadcastHashJoin" in text
    again = bucketed(spark, f"{schema}.fact_payroll")
    assert again.key == "employee_id" and again.hot_keys == ("4",)


def test_empty_bucketed_table(spark, mart):
    table = f"{fresh_schema(spark, 'b')}.t"
    stored = store_bucketed(mart["fact_payroll"].limit(0), table, "employee_id", 4)
    assert stored.hot is None and stored.rows.count() == 0


# --- drift ------------------------------------------------------------------------------------------------------------

TEXT, LONG, INT = T.StringType(), T.LongType(), T.IntegerType()


@pytest.mark.parametrize(
    ("stored", "declared", "fits"),
    [
        (INT, LONG, True), (LONG, INT, False), (LONG, TEXT, True), (TEXT, LONG, False), (T.DateType(), TEXT, False),
        (T.DoubleType(), TEXT, False), (T.BooleanType(), TEXT, True), (T.NullType(), LONG, True),
        (T.DecimalType(18, 2), T.DecimalType(28, 2), True), (T.DecimalType(18, 2), T.DecimalType(18, 4), False),
        (T.DecimalType(18, 4), T.DecimalType(20, 2), False), (INT, T.DecimalType(12, 2), True),
        (LONG, T.DecimalType(18, 2), False), (T.DoubleType(), T.DecimalType(18, 2), False), (T.DateType(), T.DateType(), True),
    ],
)
def test_what_loses_nothing(stored, declared, fits):
    assert loses_nothing(stored, declared) is fits


def test_differences_are_named_and_mended(spark):
    declared = T.StructType([T.StructField(n, t) for n, t in (("id", LONG), ("name", TEXT), ("note", TEXT), ("n", TEXT))])
    df = spark.createDataFrame([(1, "a", 7, "x", None), (2, None, None, "y", "q")], "ID int, `name ` string, n int, `a.b` string, more string")
    told = [(f.column, f.kind, f.stored) for f in compare(df.schema, declared, ["more"])]
    assert told == [
        ("id", "renamed", "ID"), ("id", "converted", "ID"), ("name", "renamed", "name "), ("note", "missing", None),
        ("n", "converted", "n"), ("a.b", "extra", "a.b"),
    ]
    out = conformed(df, declared)
    assert out.schema.simpleString() == declared.simpleString()
    assert sorted(map(tuple, out.collect())) == [(1, "a", None, "7"), (2, None, None, None)]
    rows = {(r["column_name"], r["finding"]): r["n_values"] for r in findings(spark, {"t": df}, {"t": declared}).collect()}
    assert rows["a.b", "extra"] == 2 and rows["more", "extra"] == 1 and rows["note", "missing"] == 0
    assert rows["n", "converted"] == 1
    assert findings(spark, {"t": out}, {"t": declared}).count() == 0


def test_lossy_types_stop_before_reading(spark):
    declared = T.StructType([T.StructField("a", INT), T.StructField("b", TEXT)])
    with pytest.raises(SchemaDrift, match="a is bigint, declared int; b is date, declared string"):
        conformed(spark.sql("SELECT 1L AS a, DATE'2024-01-01' AS b"), declared)


def test_exact_name_wins_over_a_like_one():
    stored = T.StructType([T.StructField("A", TEXT), T.StructField("a", TEXT)])
    found = compare(stored, T.StructType([T.StructField("a", TEXT)]))
    assert [(f.column, f.kind) for f in found] == [("A", "extra")]


def test_drifted_raw_layer_cleans_alike(spark, small):
    layout = Layout().prefixed(fresh_schema(spark, "d") + "_")
    raw = raw_layer(spark, small)
    spark.sql(f"CREATE SCHEMA {layout.raw}")
    for name in RAW:
        df = raw[name]
        if name == "employee":
            df = df.withColumnRenamed("email", "E_Mail ".replace("_", "")).withColumn("shoe_size", F.lit("42"))
        overwrite_table(df, f"{layout.raw}.{name}")
    stored = stored_as_declared(spark, layout.raw, RAW)
    for name in RAW:
        assert counted(clean_table(stored[name], name)) == counted(clean_table(raw[name], name))
    assert "shoe_size" not in plan(stored["employee"])
    store_drift(spark, layout)
    told = {(r["table_name"], r["column_name"], r["finding"]) for r in spark.table(f"{layout.clean}.dq_schema_drift").collect()}
    assert told == {("employee", "email", "renamed"), ("employee", "shoe_size", "extra")}
