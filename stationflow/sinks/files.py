"""Batch sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def save_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None, dynamic: bool = False
) -> None:
    """Parquet files; ``dynamic`` replaces only the partitions that ``df`` holds."""
    writer = df.write.mode(mode)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def save_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header row; doubles are written as their shortest decimal text."""
    df.write.mode(mode).option("header", True).csv(path)


def save_text(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One line per row of a single string column (e.g. encoded JSON payloads)."""
    df.write.mode(mode).text(path)


def save_table(
    df: DataFrame,
    name: str,
    path: str | None = None,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
) -> None:
    """Write a catalog table; with ``path`` it is an external table at that folder,
    so a leftover managed-table folder can never block the write."""
    writer = df.write.mode(mode).format("parquet")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
