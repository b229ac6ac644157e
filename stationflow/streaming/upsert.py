"""Keyed upsert for update-mode results on plain Parquet.

File sinks only take append mode, so each micro-batch's updated rows are
written by ``foreachBatch`` into their own ``batch_id=N`` folder (overwrite, so
a replayed batch rewrites the same folder: exactly-once).  Readers keep, per
key, the row of the highest batch id: a keyed aggregate, distributed like any
other, with no full-table rewrite per batch.

``compact`` merges committed batches into a *generation*: one folder with every
key's latest row and the batch that wrote it.  Which generation counts is said by
one small file, the manifest, which is replaced in one rename: a reader takes the
generation the manifest names and the batch folders after it, so a run that is cut
short at any step leaves either the old state or the new one.  What a manifest
supersedes is deleted by the next compaction only, so a reader that began before
a swap still finds its files.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.plans import pointer

MANIFEST, GENERATIONS = "_manifest", "_generations"


@dataclass(frozen=True)
class Manifest:
    """The generation in force: its folder, and the last batch it holds; the one before it likewise."""

    generation: str | None = None
    upto: int = -1
    previous_generation: str | None = None
    previous_upto: int = -1


def batch_writer(
    path: str, keys: list[str] | None = None, compact_every: int | None = None
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function; with ``compact_every`` every so many batches the ones before are compacted."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        if compact_every and batch_id and batch_id % compact_every == 0:
            # a batch starts when the one before it is committed
            compact(batch.sparkSession, path, keys, upto=batch_id - 1)

    return write


def read_latest(
    spark: SparkSession, path: str, keys: list[str], since_batch_id: int | None = None, upto: int | None = None
) -> DataFrame:
    """Current value of every key: the row written by the latest micro-batch.

    With ``since_batch_id`` only keys updated in that batch or later are
    returned (with their latest values); older ``batch_id`` folders are pruned
    by the partition filter and never read.  ``upto`` leaves out later batches;
    it has to be no less than the last compacted one.
    """
    df = _rows(spark, path, read_manifest(spark, path), upto)
    if since_batch_id is not None:
        df = df.where(F.col("batch_id") >= since_batch_id)
    latest = _latest(df, keys)
    return latest.drop("batch_id")


def compact(spark: SparkSession, path: str, keys: list[str], upto: int) -> None:
    """Merge all batches up to ``upto`` into one generation with every key's latest row.

    For batches the stream has committed (``committed_upto``): their folders are
    written no more.  A generation is written whole, then the manifest is swapped,
    then what the manifest before had superseded is deleted.
    """
    before = read_manifest(spark, path)
    if upto > before.upto and _batches(spark, path, before.upto, upto):
        name = f"upto={upto}-{uuid.uuid4().hex}"
        _write_generation(_latest(_rows(spark, path, before, upto), keys), f"{path}/{GENERATIONS}/{name}")
        _swap(spark, path, Manifest(name, upto, before.generation, before.upto))
    _clean(spark, path, read_manifest(spark, path))


def read_manifest(spark: SparkSession, path: str) -> Manifest:
    return Manifest(**(pointer.read_pointer(spark, path, MANIFEST) or {}))


def committed_upto(spark: SparkSession, checkpoint: str) -> int:
    """The last batch a query has committed, by its checkpoint; -1 before the first."""
    fs, base = pointer.folder(spark, f"{checkpoint.rstrip('/')}/commits")
    if not fs.exists(base):
        return -1
    names = (s.getPath().getName() for s in fs.listStatus(base))
    return max((int(n) for n in names if n.isdigit()), default=-1)


def _latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Every key's row of the highest batch, with that batch's id."""
    values = [c for c in rows.columns if c not in keys and c != "batch_id"]
    latest = rows.groupBy(*keys).agg(
        F.max_by(F.struct(*values), F.col("batch_id")).alias("_v"), F.max("batch_id").alias("batch_id")
    )
    return latest.select(*keys, "_v.*", "batch_id")


def _rows(spark: SparkSession, path: str, manifest: Manifest, upto: int | None) -> DataFrame:
    """The rows of the generation in force and of the batches after it."""
    parts = []
    if manifest.generation:
        parts.append(spark.read.parquet(f"{path}/{GENERATIONS}/{manifest.generation}"))
    if not parts or _batches(spark, path, manifest.upto, upto):
        after = spark.read.parquet(path).where(F.col("batch_id") > manifest.upto)
        parts.append(after if upto is None else after.where(F.col("batch_id") <= upto))
    parts = [p.withColumn("batch_id", F.col("batch_id").cast("long")) for p in parts]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _batches(spark: SparkSession, path: str, after: int, upto: int | None) -> list[int]:
    """Ids of the batch folders beyond ``after``, up to ``upto``."""
    fs, base = pointer.folder(spark, path)
    names = (s.getPath().getName() for s in fs.listStatus(base)) if fs.exists(base) else ()
    found = [int(n.split("=")[1]) for n in names if n.startswith("batch_id=")]
    return sorted(i for i in found if i > after and (upto is None or i <= upto))


def _write_generation(rows: DataFrame, path: str) -> None:
    rows.write.parquet(path)


def _swap(spark: SparkSession, path: str, manifest: Manifest) -> None:
    """Put ``manifest`` in the place of the one in force."""
    pointer.replace_pointer(spark, path, MANIFEST, asdict(manifest))


def _clean(spark: SparkSession, path: str, manifest: Manifest) -> None:
    """Delete what the manifest before the one in force had superseded, and what cut runs have left."""
    fs, base = pointer.folder(spark, path)
    for batch_id in _batches(spark, path, -1, manifest.previous_upto):
        fs.delete(pointer.child(spark, base, f"batch_id={batch_id}"), True)
    generations = pointer.child(spark, base, GENERATIONS)
    if fs.exists(generations):
        for status in fs.listStatus(generations):
            if status.getPath().getName() not in (manifest.generation, manifest.previous_generation):
                fs.delete(status.getPath(), True)
    pointer.remove_leftovers(spark, path, MANIFEST)
