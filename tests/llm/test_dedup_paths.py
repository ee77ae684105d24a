"""Where the deduplicated files lie, and what a stream leaves in the session."""

import pytest

from finloom.llm import exact_dedup
from finloom.scratch import fresh_folder


@pytest.mark.parametrize("name", ["docs", "docs/", "a[1].parquet", "x{1,2}*?/", "tail_", "-^!"])
def test_any_path_is_taken_literally(spark, edge_docs, name):
    path = f"{fresh_folder(spark, 'paths')}/{name}"
    edge_docs.write.parquet(path)
    found = exact_dedup.deduplicate(spark, path)
    assert found.count() == edge_docs.count() and found.filter("kept").count() == found.select("text_sha256").distinct().count()


def test_other_folders_are_not_read(spark, edge_docs):
    folder = fresh_folder(spark, "paths")
    for name in ("docs", "docs1", "doc", "a[1]", "a1"):
        edge_docs.write.parquet(f"{folder}/{name}")
    for name in ("docs", "a[1]"):
        assert exact_dedup.deduplicate(spark, f"{folder}/{name}").count() == edge_docs.count()


def test_settings_of_the_session_stay(spark, edge_docs):
    path = f"{fresh_folder(spark, 'paths')}/docs"
    edge_docs.write.parquet(path)
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    before = {r["key"]: r["value"] for r in spark.sql("SET").collect()}
    try:
        own = exact_dedup._own_session(spark)
        assert own.conf.get("spark.sql.shuffle.partitions") == "5"
        exact_dedup.deduplicate(spark, path).count()
        assert {r["key"]: r["value"] for r in spark.sql("SET").collect()} == before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
