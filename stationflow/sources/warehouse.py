"""Catalog (warehouse) tables: database, external Parquet tables, scans."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from stationflow.schema import DATABASE
from stationflow.sinks.versions import VERSIONS, WHOLE, part_folder, read_manifest

DEFAULT_DATABASE = DATABASE

def ensure_database(spark: SparkSession, database: str = DEFAULT_DATABASE, location: str | None = None) -> None:
    """Idempotent database; without ``location`` it lives in the session's warehouse dir."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")


def define_external_table(
    spark: SparkSession,
    name: str,
    schema: StructType,
    location: str,
    partition_by: list[str] | None = None,
) -> None:
    """Idempotent Parquet table over existing files at ``location`` (no-op when it
    already exists).  Partition folders already on disk are registered, so
    filters on partition columns prune whole folders."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING PARQUET{parts} LOCATION '{location}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def define_version_table(spark: SparkSession, name: str, path: str) -> None:
    """External table over the version in force at ``path``; an older one is switched to it.

    Without partitions the switch is one catalog operation.  Partitions are switched
    one by one, each from its old files to its new ones; files of both versions are
    there meanwhile.  A table of other columns is forgotten and defined anew.
    """
    now = read_manifest(spark, path)
    if now is None:
        raise ValueError(f"no version at {path}")
    schema = StructType.fromJson(json.loads(now.schema))
    whole = not now.partition_by
    location = part_folder(path, WHOLE, now.version) if whole else f"{path.rstrip('/')}/{VERSIONS}"
    if spark.catalog.tableExists(name):
        same = [(f.name, f.dataType) for f in spark.table(name).schema] == [(f.name, f.dataType) for f in schema]
        if not same or not _is_version_table(spark, name, path):
            drop_table(spark, name)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        by = "" if whole else f" PARTITIONED BY (`{now.partition_by[0]}`)"
        spark.sql(f"CREATE TABLE {name} ({columns}) USING PARQUET{by} LOCATION '{location}'")
    elif whole:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
    if not whole:
        _switch_partitions(spark, name, {part: part_folder(path, part, v) for part, v in now.parts.items()})
    spark.catalog.refreshTable(name)


def _is_version_table(spark: SparkSession, name: str, path: str) -> bool:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return bool(rows) and f"{path.rstrip('/')}/{VERSIONS}" in rows[0]["data_type"]


def _switch_partitions(spark: SparkSession, name: str, folders: dict[str, str]) -> None:
    known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}  # days, not rows
    new = [f"PARTITION ({_spec(part)}) LOCATION '{folder}'" for part, folder in sorted(folders.items()) if part not in known]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(new)}")
    for part in sorted(known):
        if part in folders:
            spark.sql(f"ALTER TABLE {name} PARTITION ({_spec(part)}) SET LOCATION '{folders[part]}'")
        else:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({_spec(part)})")


def _spec(part: str) -> str:
    """``date=2024-01-01`` as a partition of SQL; the folder of nulls as null."""
    column, value = part.split("=", 1)
    return f"`{column}` = null" if value in ("__HIVE_DEFAULT_PARTITION__", "null") else f"`{column}` = '{value}'"


def drop_table(spark: SparkSession, name: str) -> None:
    """Forget a table; the files of an external one stay."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def scan(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
