"""Landing CSV files as all-text raw tables."""

from __future__ import annotations

import re
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finloom.schemas import MANIFEST, RAW
from finloom.sinks.tables import ensure_schema, overwrite_table, quoted, write_together

AUDIT_COLUMNS = ("_source_file", "_ingested_at", "_batch_id")
MALFORMED = "_malformed"


def read_csv_text(
    spark: SparkSession, path: str | list[str], schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """Read CSV with a header, every column text.

    Blanks around header names and values are dropped and a byte order mark is ignored. The header is
    checked against the schema, so a file with other or reordered columns fails instead of shifting values.
    ``multi_line`` allows line breaks within quotes; files are then no longer split.
    """
    return _csv_options(spark.read.schema(schema), multi_line).csv(path)


def _csv_options(reader, multi_line: bool):
    """The options of a batch or stream reader."""
    return (
        reader.option("columnNameOfCorruptRecord", MALFORMED)
        .option("columnPruning", False)  # a line is judged by all its values, whichever columns are used
        .option("multiLine", multi_line)
        .option("header", True)
        .option("enforceSchema", False)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
    )


def read_csv_checked(
    spark: SparkSession, path: str | list[str], schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """``read_csv_text`` with the whole line in MALFORMED where its values do not match the columns."""
    return read_csv_text(spark, path, T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())]), multi_line)


def with_audit(df: DataFrame, batch_id: str) -> DataFrame:
    """Add the file each row came from, the load time and the batch."""
    return df.withColumns(
        {
            "_source_file": F.col("_metadata.file_name"),
            "_ingested_at": F.current_timestamp(),
            "_batch_id": F.lit(batch_id),
        }
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The control table: one row per file with its target schema and table."""
    return read_csv_text(spark, path, MANIFEST)


def _resolved(spark: SparkSession, landing: str, name: str) -> str:
    """The landed file or folder of that name, with or without the extension."""
    jvm = spark.sparkContext._jvm
    for candidate in (f"{landing}/{name}", f"{landing}/{name}.csv"):
        path = jvm.org.apache.hadoop.fs.Path(candidate)
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return candidate
    raise FileNotFoundError(f"{landing} has neither {name} nor {name}.csv")


def _by_table(
    spark: SparkSession, manifest: DataFrame, landing: str, schema_prefix: str
) -> dict[tuple[str, str], list[str]]:
    """Paths of the manifest's files by schema and table. Only the manifest, a row per file, is collected."""
    found: dict[tuple[str, str], list[str]] = {}
    for row in manifest.collect():
        if row["table_name"] not in RAW:
            raise ValueError(f"the manifest names an unknown table: {row['table_name']}")
        key = (schema_prefix + row["sink_schema"], row["table_name"])
        found.setdefault(key, []).append(_resolved(spark, landing, row["file_name"]))
    return found


def _land(spark: SparkSession, name: str, paths: list[str], batch_id: str, table: str, table_format: str) -> None:
    """Write good lines while looking for bad ones; files that have some, if any, are read again for these."""
    rows = with_audit(read_csv_checked(spark, paths, RAW[name]), batch_id).withColumn("_path", F.col("_metadata.file_path"))
    seen, bad = Observation(), F.col(MALFORMED).isNotNull()
    rows = rows.observe(seen, F.collect_set(F.when(bad, F.col("_path"))).alias("files"))  # names of landed files at most
    overwrite_table(rows.filter(~bad).drop(MALFORMED, "_path"), table, table_format)
    with_bad = seen.get["files"]
    again = with_audit(read_csv_checked(spark, with_bad or paths[:1], RAW[name]), batch_id).filter(bad)
    again = again.select(*RAW[name].names, MALFORMED, *AUDIT_COLUMNS)
    overwrite_table(again if with_bad else again.limit(0), f"{table}_rejects", table_format)


def ingest(
    spark: SparkSession,
    manifest: DataFrame,
    landing: str,
    batch_id: str,
    schema_prefix: str = "",
    table_format: str = "parquet",
) -> list[str]:
    """Load the files the manifest names into their raw tables, with audit columns; returns the table names.

    All files of a table are one distributed read, parsed once. Lines with too many or too few values go, as they are and
    with their file, to ``<table>_rejects`` beside the table; nothing is cut or padded. Unknown tables and missing files
    fail before anything is written.
    """
    files = _by_table(spark, manifest, landing, schema_prefix)
    writes = []
    for (schema, name), paths in files.items():
        ensure_schema(spark, schema)
        writes.append(partial(_land, spark, name, paths, batch_id, f"{schema}.{name}", table_format))
    write_together(spark, writes)
    return [f"{schema}.{name}" for schema, name in files]


REJECTED = "_rejected"


def _pattern(paths: list[str]) -> str:
    """One path that stands for the given ones, of one folder: a file stream takes a pattern, not a list."""
    folder, names = paths[0].rsplit("/", 1)[0], [p.rsplit("/", 1)[1] for p in paths]
    return f"{folder}/{{{','.join(re.sub(r'([][{}*?,^-])', lambda m: chr(92) + m[1], n) for n in names)}}}"


def ingest_increment(
    spark: SparkSession, manifest: DataFrame, landing: str, batch_id: str, state: str, schema_prefix: str = ""
) -> list[str]:
    """Load those of the manifest's files that no earlier run with this ``state`` folder has loaded, and add their rows.

    Each table is a stream of files with a log of those it has taken, and a sink that commits whole batches: a run that
    fails halfway is finished by the next, no file is loaded twice or left out, and a run without new files adds nothing.
    Every file is parsed once, good and malformed lines go to two partitions of one write. The tables are views over
    committed rows, with the columns that ``ingest`` gives. ``state`` must be a folder all executors share; a file is known
    by its path, so a changed file needs a new name.
    """
    files = _by_table(spark, manifest, landing, schema_prefix)
    for (schema, name), paths in files.items():
        ensure_schema(spark, schema)
        folder = f"{state}/{schema}/{name}"
        checked = T.StructType([*RAW[name].fields, T.StructField(MALFORMED, T.StringType())])
        stream = _csv_options(spark.readStream.schema(checked), False).csv(_pattern(paths))
        rows = with_audit(stream, batch_id).withColumn(REJECTED, F.col(MALFORMED).isNotNull().cast("int"))
        query = (
            rows.writeStream.format("parquet")
            .partitionBy(REJECTED)
            .option("path", f"{folder}/rows")
            .option("checkpointLocation", f"{folder}/log")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        _show_landed(spark, f"{schema}.{name}", name, f"{folder}/rows")
    return [f"{schema}.{name}" for schema, name in files]


def _show_landed(spark: SparkSession, table: str, name: str, folder: str) -> None:
    """Views of the good and of the malformed lines among the rows the sink has committed."""
    landed = {**dict.fromkeys([*RAW[name].names, MALFORMED, "_source_file", "_batch_id"], "STRING")}
    landed |= {"_ingested_at": "TIMESTAMP", REJECTED: "INT"}
    try:
        spark.read.parquet(folder)
        source = f"parquet.`{folder}`"
    except AnalysisException:  # nothing but a log yet: no file had a line
        nothing = ", ".join(f"CAST(NULL AS {kind}) AS {column}" for column, kind in landed.items())
        source = f"(SELECT {nothing} WHERE false)"
    for view, columns, which in (
        (table, [*RAW[name].names, *AUDIT_COLUMNS], f"{REJECTED} = 0"),
        (f"{table}_rejects", [*RAW[name].names, MALFORMED, *AUDIT_COLUMNS], f"{REJECTED} = 1"),
    ):
        spark.sql(f"CREATE OR REPLACE VIEW {quoted(view)} AS SELECT {', '.join(columns)} FROM {source} WHERE {which}")
