"""The pipeline's stages, and the registered queries against SQL."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from compare import difference
from finloom.llm import decontaminate, mixing, near_dedup, quality
from finloom.llm.queries import fold
from finloom.llm.sql import QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_sql(spark, small, name):
    con = duckdb.connect()
    for table in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    result = registry.queries()[name](spark, small)
    assert difference(result, con, QUERIES[name]) is None
    described = {row[0]: row[1] for row in con.execute(f"DESCRIBE {QUERIES[name]}").fetchall()}
    kinds = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "boolean": "BOOLEAN"}
    assert {c: kinds[t] for c, t in result.dtypes} == described


def test_pipeline(spark, small):
    """Every stage takes all that the one before kept, and what it decides is gone from the next."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality"](spark, docs, small)
    score = quality.scorer(quality.fit(docs, labels, fold("doc_id", 4) != 2))
    rejected = {r[0] for r in docs.select("doc_id", score("text").alias("s")).filter("s < 0.7").collect()}
    assert {r["doc_id"] for r in good.collect()} == {r["doc_id"] for r in docs.collect()} - rejected
    single = stages["near_dedup"](spark, good, small)
    kept = {r["doc_id"] for r in near_dedup.near_duplicates(good).filter("kept").collect()}
    assert {r["doc_id"] for r in single.collect()} == kept
    clean = stages["decontamination"](spark, single, small)
    benchmark = spark.read.parquet(f"{small}/benchmark.parquet")
    leaks = single.filter(F.size(decontaminate.matched_items(single, benchmark)) > 0)
    assert {r["doc_id"] for r in clean.collect()} == kept - {r["doc_id"] for r in leaks.collect()}
    mixed = stages["mixing"](spark, clean, small)
    assert all(f.columns == columns for f in (good, single, clean, mixed))
    times = Counter(r["doc_id"] for r in mixed.collect())
    for r in mixing.taken(clean).filter("size > 0").collect():
        assert times[r["doc_id"]] * r["size"] == r["taken"]
    result = registry.queries()["pipeline"](spark, small).collect()
    assert Counter(r["doc_id"] for r in result) == times
    sizes = Counter(r["shard"] for r in result)
    assert max(sizes.values()) - min(sizes.values()) <= 1
