"""Exact deduplication with streaming state.

A Structured Streaming aggregation over the document files keeps, for each text digest, the identifier that stays (the
largest doc_id), the locator of its content (file and row) and the number of documents. The state lives in RocksDB on
the executors' disks and in the checkpoint folder, has no watermark and never expires; running again on the same
checkpoint folder takes in only new files. The state is then read as a table, and every document is resolved against it.

A digest alone decides nothing: the whole text of each document whose digest occurs more than once is compared with the
text at the keeper's locator. Documents that differ, a digest collision, are grouped by their text itself.

Only DataFrame and SQL functions are used. Copies are counted before each shuffle, also those with a third of all rows
(one row per digest and task); joins meet one row per digest on one side, so adaptive execution can split a hot one.

Defined results: null texts are empty texts; rows with equal doc_id and text are copies of each other and one row stays
(the last by locator); a null doc_id stays only if its text has no other; columns beside doc_id and text are not read;
an empty table gives an empty result. The path is taken literally: a slash at its end and characters of patterns in it
mean themselves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.llm.store import stored
from finloom.scratch import fresh_folder

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # an open store holds 4 MB of disk in advance, however few rows it has; one pass needs each store once
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def normalised(text: Column) -> Column:
    """A-Z as a-z, all else as it is. Texts of one byte a character take the cheaper of two equal ways."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _own_session(spark: SparkSession) -> SparkSession:
    """A session with the settings of this one and those of the state, so that no query beside it sees them."""
    own = spark.newSession()
    for row in spark.sql("SET").collect():
        if own.conf.isModifiable(row["key"]):
            own.conf.set(row["key"], row["value"])
    for key, value in _STATE.items():
        own.conf.set(key, value)
    return own


def plain_path(path: str) -> str:
    """The path with what readers take for patterns escaped, without a slash at its end."""
    return "".join(f"\\{c}" if c in "{}[]*?\\" else c for c in path.rstrip("/"))


def as_pattern(path: str) -> str:
    """A pattern that matches the path alone: the streaming source takes a plain path for folders only."""
    bare = path.rstrip("/")
    at = max((i for i, c in enumerate(bare) if c.isalnum()), default=len(bare))
    return plain_path(bare[:at]) + "".join(f"[{c}]" for c in bare[at : at + 1]) + plain_path(bare[at + 1 :])


def _documents(source: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """doc_id, digest, normalised text, locator of every row of a file source."""
    # batch and streaming sources write the slashes after the scheme differently
    file = F.regexp_replace(F.col("_metadata.file_path"), "^([A-Za-z0-9+.-]+):/+", "$1:/")
    text = normalised(F.col("text"))
    return source.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        digest(text).alias("digest"),
        text.alias("text"),
        F.struct(file.alias("file"), F.col("_metadata.row_index").alias("row")).alias("at"),
    )


def update_state(spark: SparkSession, path: str, checkpoint: str, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """Take in the files at `path` that the checkpoint has not seen; the state: digest, keep (doc_id, at), n."""
    schema = spark.read.parquet(plain_path(path)).schema
    source = _own_session(spark).readStream.schema(schema).parquet(as_pattern(path))
    state = (
        _documents(source, digest)
        .groupBy("digest")
        .agg(F.max(F.struct("doc_id", "at")).alias("keep"), F.count("*").alias("n"))
    )
    query = (
        state.writeStream.format("noop")
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    table = spark.read.format("statestore").load(checkpoint)
    return table.select(
        F.col("key.digest").alias("digest"), F.col("value.max").alias("keep"), F.col("value.count").alias("n")
    )


def deduplicate(
    spark: SparkSession, path: str, checkpoint: str | None = None, digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """One row per document in the files at `path`: doc_id, keep_id, group_size, kept, text_sha256."""
    state = update_state(spark, path, checkpoint or fresh_folder(spark, "dedup-state"), digest)
    state = stored(state, "dedup-digests")
    documents = _documents(spark.read.parquet(plain_path(path)), digest)
    # full bytes of every hit against the keeper's; texts seen once are not moved on
    repeated = state.filter("n > 1").select("digest", F.col("keep.at").alias("keeper_at"))
    hits = stored(documents.join(repeated, "digest"), "dedup-hits")
    keepers = hits.filter("at = keeper_at").select("digest", F.col("text").alias("keeper_text"))
    compared = hits.join(keepers, "digest")
    differ = compared.filter("text != keeper_text").select("digest", "text", "doc_id", "at")
    differ = stored(differ, "dedup-collisions")  # empty but for digest collisions
    own = differ.groupBy("digest", "text").agg(F.max(F.struct("doc_id", "at")).alias("own"), F.count("*").alias("own_n"))
    collided = differ.join(own, ["digest", "text"]).select(F.col("at").alias("differ_at"), "own", "own_n")
    gone = differ.groupBy("digest").agg(F.count("*").alias("gone"))
    rows = documents.select("doc_id", "digest", "at", sha256(F.col("text")).alias("text_sha256"))
    resolved = (
        rows.join(state, "digest")
        .join(gone, "digest", "left")
        .join(collided, F.col("at") == F.col("differ_at"), "left")
        .withColumn("stays", F.coalesce("own", "keep"))
    )
    return resolved.select(
        "doc_id",
        F.col("stays.doc_id").alias("keep_id"),
        F.coalesce("own_n", F.col("n") - F.coalesce("gone", F.lit(0))).alias("group_size"),
        (F.col("at") == F.col("stays.at")).alias("kept"),
        "text_sha256",
    )
