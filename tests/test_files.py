"""Landing CSV files and the control table."""

import codecs

import pytest
from pyspark.sql import functions as F

from finloom.schemas import MANIFEST, RAW
from finloom.scratch import fresh_schema, shared_root
from finloom.sources.files import AUDIT_COLUMNS, ingest, read_csv_checked, read_csv_text, read_manifest, with_audit


def write(path, text, bom=False):
    path.write_bytes((codecs.BOM_UTF8 if bom else b"") + text.encode())
    return str(path)


def test_mark_blanks_and_line_ends(spark, tmp_path):
    path = write(tmp_path / "control.csv", "file_name,sink_schema,table_name \r\ncompany , raw,company\r\n", bom=True)
    control = read_manifest(spark, path)
    assert control.columns == MANIFEST.names
    assert [tuple(r) for r in control.collect()] == [("company", "raw", "company")]


def test_everything_is_text_and_empty_is_null(spark, tmp_path):
    path = write(tmp_path / "d.csv", "department_id,department_code,department_name,cost_center\n007,,Sales,1e3\n")
    rows = read_csv_text(spark, path, RAW["departments"])
    assert set(dict(rows.dtypes).values()) == {"string"}
    assert tuple(rows.first()) == ("007", None, "Sales", "1e3")


def test_reordered_header_fails(spark, tmp_path):
    path = write(tmp_path / "d.csv", "department_code,department_id,department_name,cost_center\nA,1,Sales,x\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_csv_text(spark, path, RAW["departments"]).collect()


def test_audit_columns(spark, tmp_path):
    path = write(tmp_path / "d.csv", "department_id,department_code,department_name,cost_center\n1,A,Sales,x\n")
    row = with_audit(read_csv_text(spark, path, RAW["departments"]), "b7").first()
    assert (row["_source_file"], row["_batch_id"]) == ("d.csv", "b7")
    assert row["_ingested_at"] is not None


def test_ingest_follows_the_control_table(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    write(folder / "deps", "department_id,department_code,department_name,cost_center\n1,A,Sales,x\n2,B,HR,y\n")
    control = spark.createDataFrame([("deps", "raw", "departments")], MANIFEST)
    prefix = fresh_schema(spark, "t") + "_"
    for batch in ("b1", "b2"):
        assert ingest(spark, control, str(folder), batch, prefix) == [f"{prefix}raw.departments"]
    stored = spark.table(f"{prefix}raw.departments")
    assert stored.columns == [*RAW["departments"].names, *AUDIT_COLUMNS]
    assert stored.groupBy("_batch_id").agg(F.count("*").alias("n")).collect() == [("b2", 2)]


def test_ingest_loses_nothing(spark, tmp_path):
    """Two files of one table, named without extension; malformed lines are kept beside the table."""
    folder = tmp_path / "landing"
    folder.mkdir()
    head = "department_id,department_code,department_name,cost_center\n"
    write(folder / "d1.csv", head + "1,A,Sales,x\n3,C,Y,z,extra\n2,B\n")
    write(folder / "d2.csv", head + "4,D,HR,y\n")
    control = spark.createDataFrame([("d1", "raw", "departments"), ("d2", "raw", "departments")], MANIFEST)
    prefix = fresh_schema(spark, "t") + "_"
    assert ingest(spark, control, str(folder), "b", prefix) == [f"{prefix}raw.departments"]
    stored = spark.table(f"{prefix}raw.departments")
    assert {(r["department_id"], r["_source_file"]) for r in stored.collect()} == {("1", "d1.csv"), ("4", "d2.csv")}
    bad = {(r["_malformed"], r["_source_file"]) for r in spark.table(f"{prefix}raw.departments_rejects").collect()}
    assert bad == {("3,C,Y,z,extra", "d1.csv"), ("2,B", "d1.csv")}


def test_ingest_fails_before_it_writes(spark, tmp_path):
    write(tmp_path / "d.csv", "department_id,department_code,department_name,cost_center\n1,A,Sales,x\n")
    prefix = fresh_schema(spark, "t") + "_"
    for row, error in ((("d", "raw", "nonsense"), "unknown table"), (("e", "raw", "departments"), "neither e nor e.csv")):
        control = spark.createDataFrame([("d", "raw", "departments"), row], MANIFEST)
        with pytest.raises(Exception, match=error):
            ingest(spark, control, str(tmp_path), "b", prefix)
        assert not spark.catalog.databaseExists(f"{prefix}raw")


def test_quoted_line_break(spark, tmp_path):
    path = write(tmp_path / "d.csv", 'department_id,department_code,department_name,cost_center\n1,A,"Sa\nles",x\n')
    assert read_csv_text(spark, path, RAW["departments"], multi_line=True).first()["department_name"] == "Sa\nles"
    split = read_csv_checked(spark, path, RAW["departments"]).filter("_malformed is not null")
    assert len(split.collect()) == 2  # reported, not stored as two rows


def test_scratch_follows_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_cluster_without_shared_folder_is_refused():
    class Session:
        class conf:
            @staticmethod
            def get(name, default):
                return default

        class sparkContext:
            master = "spark://somewhere:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(Session)
