"""Shared scratch storage for lineage cuts, round trips and stream state.

On a cluster every executor must reach these files, so the root is the folder
the cluster names in ``spark.checkpoint.dir`` (HDFS, S3, ...).  Where that
setting is unset, as in tests, the root lies beside the session's warehouse
folder, which driver and executors share as well; a cluster session that has
neither on a shared file system is refused.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - remote (Connect) sessions have no context
        return None


def checkpoint_root(spark: SparkSession) -> str:
    sc = _context(spark)
    root = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc else None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "-scratch"
        master = sc.master if sc else spark.conf.get("spark.master", "")
        if root.startswith(("file:", "/")) and not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if sc and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def parallelism(spark: SparkSession) -> int:
    """Cores the session can use (default parallelism), for sizing small outputs."""
    sc = _context(spark)
    if sc:
        return sc.defaultParallelism
    return int(spark.conf.get("spark.default.parallelism", "8"))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the shared root; ``remove_path`` frees it."""
    return f"{checkpoint_root(spark)}/stationflow/{label}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder on whatever file system holds it."""
    if f"{checkpoint_root(spark)}/" not in path:
        raise ValueError(f"not a scratch folder: {path}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint.

    The checkpoint lives under ``spark.checkpoint.dir`` so a lost executor
    does not force a recomputation from the source tables.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
