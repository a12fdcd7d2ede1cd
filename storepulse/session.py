"""Session construction and shared scratch locations.

Every job writes intermediate tables and streaming checkpoints below the folder the
cluster names in ``spark.checkpoint.dir``; we only pick our own (a fresh temporary
folder) when the session has none, as in tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter at any scale; shuffle parallelism is left to AQE on a cluster.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove reliable checkpoint files (BM25 statistics, materialized hits) once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# State of the streams that keep keys: on disk, with changelog checkpoints.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Starting points for a large cluster (hundreds of executors, tens of TB per job): many
# initial shuffle partitions that AQE coalesces to ~256 MB, larger file splits, and state on disk.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16384",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    **STATE_CONF,
}


def build_session(master: str | None = None, app: str = "storepulse",
                  shuffle_partitions: int | None = None, extra: dict | None = None,
                  cluster: bool = False) -> SparkSession:
    """Create (or reuse) a session with the library's defaults.

    ``master`` is only set when given; on a cluster the launcher decides it, and
    ``cluster=True`` adds :data:`CLUSTER_CONF`.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if cluster:
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)
    return spark


@contextmanager
def settings(spark: SparkSession, own: dict[str, str]):
    """What runs or starts inside has these SQL settings; afterwards the session has its own again."""
    old = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# Input bytes (compressed columns) behind one shuffle partition, and shuffled bytes in one task, of joins in bounded memory.
PART_INPUT = 4 << 20
TASK_SHUFFLE = 16 << 20


def bounded_tasks(spark: SparkSession, paths) -> dict[str, str]:
    """Settings under which a task of a join or sort over the files ``paths`` has as much to hold whatever their size:
    shuffles start with partitions in proportion to the files' bytes, and AQE joins small ones to ``TASK_SHUFFLE`` bytes only."""
    size = sum(fs.getContentSummary(p).getLength() for fs, p in (hadoop_path(spark, path) for path in paths))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_INPUT))
    return {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TASK_SHUFFLE)}


_LOCAL_ROOT: dict[int, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables and checkpoints.

    Order: ``spark.checkpoint.dir`` from the session, then a checkpoint dir set on the
    context, then (local masters only) a fresh local temporary folder which is also installed
    as the context's checkpoint dir. On a cluster without a shared folder it raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    master = sc.master or ""
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    key = id(sc)
    if key not in _LOCAL_ROOT:
        _LOCAL_ROOT[key] = tempfile.mkdtemp(prefix="storepulse-")
        sc.setCheckpointDir(_LOCAL_ROOT[key])
    return _LOCAL_ROOT[key]


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of ``path`` in whatever store it lies, for folder operations."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def existing(spark: SparkSession, paths) -> list[str]:
    """Those of ``paths`` that exist."""
    found = ((p, hadoop_path(spark, p)) for p in paths)
    return [p for p, (fs, hp) in found if fs.exists(hp)]


def _scratch_of(spark: SparkSession) -> str:
    return os.path.join(scratch_root(spark), "storepulse", spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder name below the application's scratch folder (not created)."""
    return os.path.join(_scratch_of(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def remove_scratch(spark: SparkSession) -> None:
    """Remove all scratch folders of this application. Results that are DataFrames read them: call it when
    those are written or no longer needed, before the session stops."""
    fs, folder = hadoop_path(spark, _scratch_of(spark))
    fs.delete(folder, True)
