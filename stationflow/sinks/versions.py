"""Outputs that can be rewritten while they are read.

Under the output's folder every write makes a new ``version=N`` folder; a small
manifest names the version that counts, for a partitioned output the version of
every partition.  It is replaced in one rename once the new files are there, so
readers see the old rows or the new ones and a failed run leaves the old.  What a
manifest supersedes stays until the write after next, for readers under way.
One writer at a time; any number of readers.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from stationflow.plans import pointer
from stationflow.sinks.files import save_parquet

MANIFEST, VERSIONS = "_current", "_versions"
#: Name of the one part of an output without partitions.
WHOLE = ""


@dataclass(frozen=True)
class Current:
    """What counts: every part (``date=2024-01-01``) with the version that holds it, and the parts before."""

    version: int
    schema: str
    parts: dict[str, int]
    partition_by: list[str] = field(default_factory=list)
    before: dict[str, int] = field(default_factory=dict)


def read_manifest(spark: SparkSession, path: str) -> Current | None:
    found = pointer.read_pointer(spark, path, MANIFEST)
    return Current(**found) if found else None


def part_folder(path: str, part: str, version: int) -> str:
    return f"{path.rstrip('/')}/{VERSIONS}/version={version}" + (f"/{part}" if part else "")


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the version in force; plain Parquet files where ``path`` has no versions."""
    now = read_manifest(spark, path)
    if now is None:
        return spark.read.parquet(path)
    schema = StructType.fromJson(json.loads(now.schema))
    if not now.parts:
        return spark.createDataFrame([], schema)
    folders = [part_folder(path, part, version) for part, version in sorted(now.parts.items())]
    reader = spark.read.schema(schema)
    if now.partition_by:
        reader = reader.option("basePath", f"{path.rstrip('/')}/{VERSIONS}")
    return reader.parquet(*folders).select(schema.names)


def save_version(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    keep_others: bool = False,
    write: Callable[..., None] = save_parquet,
) -> Current:
    """Write ``df`` as the next version of the output at ``path`` and put it in force.

    With ``keep_others`` (partitioned outputs) partitions that ``df`` doesn't hold
    stay as they are: their files are neither read nor written.  ``df`` may read the
    version in force.  The driver sees the partitions' names, never rows.
    """
    spark = df.sparkSession
    now = read_manifest(spark, path)
    fields = [partition_by] if partition_by else []
    if now and keep_others and now.partition_by != fields:
        raise ValueError(f"{path} is partitioned by {now.partition_by}, not by {fields}")
    version = 1 + max(_versions(spark, path), default=0)
    target = part_folder(path, WHOLE, version)
    write(df, target, mode="error", partition_by=fields)
    written = [n for n in pointer.names_in(spark, target) if n.startswith(f"{partition_by}=")] if partition_by else [WHOLE]
    kept = now.parts if now and keep_others else {}
    columns = [f for f in df.schema.fields if f.name not in fields] + [df.schema[c] for c in fields]
    current = Current(
        version, StructType(columns).json(), kept | dict.fromkeys(written, version), fields, now.parts if now else {}
    )
    pointer.replace_pointer(spark, path, MANIFEST, asdict(current))
    _clean(spark, path, current)
    return current


def _versions(spark: SparkSession, path: str) -> list[int]:
    names = pointer.names_in(spark, f"{path.rstrip('/')}/{VERSIONS}")
    return [int(n.split("=")[1]) for n in names if n.startswith("version=")]


def _clean(spark: SparkSession, path: str, current: Current) -> None:
    """Delete parts that neither the manifest nor the one before it names."""
    held = set(current.parts.items()) | set(current.before.items())
    fs, _ = pointer.folder(spark, path)
    for version in _versions(spark, path):
        root = part_folder(path, WHOLE, version)
        if version not in {v for _, v in held}:
            fs.delete(pointer.folder(spark, root)[1], True)
        elif current.partition_by and (WHOLE, version) not in held:
            for part in pointer.names_in(spark, root):
                if "=" in part and (part, version) not in held:
                    fs.delete(pointer.folder(spark, f"{root}/{part}")[1], True)
    pointer.remove_leftovers(spark, path, MANIFEST)
