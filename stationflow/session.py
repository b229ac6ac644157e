"""Session settings for jobs, tests and the bench."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(
    master: str | None = None,
    app: str = "stationflow",
    shuffle_partitions: int | None = None,
    large_state: bool | None = None,
    hive: bool = False,
    tasks_per_core: int = 3,
) -> SparkSession:
    """A session with AQE on (coalesce small partitions, split skewed joins) and UTC.

    ``spark.sql.shuffle.partitions`` defaults to 8 in local mode.  On a cluster
    a value set by the deployment wins; otherwise it starts at three tasks per
    core (``cluster_shuffle_partitions``) and AQE coalesces small partitions
    toward 128 MB.  AQE can merge partitions but not split an aggregate's, so
    the start must be high: Spark's default of 200 would put ~500 GB in each
    partition of a 100 TB shuffle.  Streaming jobs pass ``tasks_per_core=1``:
    there the count also fixes the state-store partitions, scheduled in every
    micro-batch.  ``large_state`` (default: not in local mode) keeps
    streaming state in RocksDB: off-heap, spilling to local disk, uploading
    only changes per batch.  Small local state is faster in the default
    in-memory provider (measured ~25% on the window stream at sf0.1).
    ``hive`` uses a persistent Hive metastore for the warehouse tables (the
    cluster's, via its configuration), falling back to the in-memory catalog
    when Hive support is unavailable.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    local = master is not None and master.startswith("local")
    parts = shuffle_partitions or (8 if local else None)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # remove checkpoint files of materialized tables once nothing refers to them
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if parts:
        conf["spark.sql.shuffle.partitions"] = str(parts)
    if large_state if large_state is not None else not local:
        conf["spark.sql.streaming.stateStore.providerClass"] = (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        )
        conf["spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"] = "true"
    if local:
        conf["spark.driver.memory"] = "8g"
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = None
    if hive:
        try:
            spark = builder.enableHiveSupport().getOrCreate()
        except Exception:  # noqa: BLE001 - no Hive classes or metastore: plain catalog
            spark = None
    if spark is None:
        spark = builder.getOrCreate()
    sc = spark.sparkContext
    sc.setLogLevel("ERROR")
    if not local and not sc.getConf().contains("spark.sql.shuffle.partitions"):
        spark.conf.set(
            "spark.sql.shuffle.partitions", str(cluster_shuffle_partitions(sc.defaultParallelism, tasks_per_core))
        )
    return spark


def cluster_shuffle_partitions(cores: int, tasks_per_core: int = 3, floor: int = 200) -> int:
    """Initial shuffle partitions for a cluster: enough that AQE only ever merges."""
    return max(floor, cores * tasks_per_core)
