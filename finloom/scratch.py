"""Shared place for the tables a query has to write before it can answer."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}
_schemas: dict[str, list[str]] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the session.

    A local session without the setting gets one temporary folder per application; a cluster without it is
    refused, since a folder of the driver's machine would be lost on the executors.
    """
    root = spark.conf.get(_SETTING, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_SETTING} to a folder all executors share")
        application = spark.sparkContext.applicationId
        root = _local_roots.setdefault(application, "") or tempfile.mkdtemp(prefix="finloom-")
        _local_roots[application] = root
    return root.rstrip("/")


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_root(spark)}/finloom/{purpose}-{uuid.uuid4().hex}"


def fresh_schema(spark: SparkSession, purpose: str) -> str:
    """A new catalog schema whose managed tables live in the shared folder."""
    name = f"finloom_{purpose}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{fresh_folder(spark, purpose)}'")
    _schemas.setdefault(spark.sparkContext.applicationId, []).append(name)
    return name


def drop_scratch(spark: SparkSession) -> None:
    """Drop the schemas, with their tables, that this application made by `fresh_schema`; results that were returned
    from them can no longer be read."""
    for name in _schemas.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")
