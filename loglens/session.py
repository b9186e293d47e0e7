"""Session construction and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every loglens job relies on. Time zone: log time stamps are
# instants; all windows, hours and dates are computed in UTC.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Sensible defaults for a fresh session; an existing session keeps its own.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Upload only the changelog of each micro-batch, not a full snapshot.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
}


MB = 1024 * 1024


def scale_conf(input_bytes: int, cores: int, split_bytes: int = 256 * MB,
               shuffle_bytes_per_partition: int = 1024 * MB) -> dict[str, str]:
    """Settings sized to an input of ``input_bytes`` on ``cores`` task slots.

    * scan splits of ``split_bytes`` (Parquet row groups are read whole), so
      100 TB is ~400k scan tasks, about 50 waves on 8000 slots;
    * an initial shuffle width of one partition per ``shuffle_bytes_per_partition``
      of input (at least two per slot). Metric shuffles carry
      only partial aggregates, far less than the input, and AQE coalesces
      them to ``advisoryPartitionSizeInBytes``; wide ones (distinct IP x
      endpoint) keep enough partitions to stay in memory;
    * AQE skew handling splits any oversized shuffle partition.
    """
    width = max(2 * cores, -(-input_bytes // shuffle_bytes_per_partition))
    return {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(width),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * MB),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def build_session(master: str | None = None, app_name: str = "loglens",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None,
                  input_bytes: int | None = None, cores: int | None = None) -> SparkSession:
    """Build (or reuse) a session configured for loglens jobs.

    On a cluster leave ``master`` unset (spark-submit decides) and pass
    ``input_bytes`` and ``cores`` to size splits and shuffles with
    ``scale_conf``; ``shuffle_partitions`` sets the width directly.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if input_bytes and cores:
        conf.update(scale_conf(input_bytes, cores))
    conf.update(REQUIRED_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings loglens semantics depend on to an existing session."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


_ROOT_KEY = "spark.loglens.sharedRoot"


# Whether a folder of the local file system is a mount that all executors share; unset, it is tried out.
SHARED_MOUNT_KEY = "spark.loglens.sharedMount"


def resolve_root(configured: str | None, context_dir: str | None, master: str,
                 default_fs: str = "file:///", shared_mount: bool = False) -> str | None:
    """The shared root from the session's settings, or None if a local-mode
    session may create its own. Raises on a cluster without one: a
    machine-local folder there would not be visible to other executors.

    A path without a scheme belongs to the default file system, so ``/ckpt`` is fine where that is
    HDFS or an object store; a folder of the local file system needs ``shared_mount``."""
    root = configured or context_dir
    master = master or ""
    if root:
        own = master.split("[")[0] == "local" or master.startswith("local-cluster") or shared_mount
        of_machine = root.startswith("file:") or ("://" not in root and default_fs.startswith("file:"))
        if of_machine and not own:
            raise RuntimeError(
                f"{root} is a folder of one machine; set spark.checkpoint.dir to one that all executors share, "
                f"or {SHARED_MOUNT_KEY}=true if it is a shared mount")
        return root
    if not master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a cluster-shared folder "
            "(HDFS/S3/ABFS) before running loglens streaming or lineage-cutting jobs")
    return None


def seen_by_all(spark: SparkSession, root: str) -> bool:
    """Whether what tasks write below ``root`` is there for the driver and for other tasks: tried
    with a row from every task slot."""
    slots = max(2, spark.sparkContext.defaultParallelism)
    path = f"{root.rstrip('/')}/loglens-probe-{uuid.uuid4().hex[:12]}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        # As many partitions as slots, so that each executor writes and reads some.
        spark.range(0, slots, 1, slots).write.parquet(path)
        return spark.read.schema("id long").parquet(path).count() == slots
    except Exception:  # noqa: BLE001 - whatever fails here, the folder is of no use
        return False
    finally:
        fs.delete(p, True)


def shared_root(spark: SparkSession) -> str:
    """The cluster-shared folder for checkpoints, feeds and written tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).
    Only a local-mode session without one gets a fresh temporary folder,
    registered as the context's checkpoint dir so later calls agree.
    """
    known = (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_ROOT_KEY, None),
             spark.sparkContext.getCheckpointDir(), spark.sparkContext.master,
             spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///"))
    mount = spark.conf.get(SHARED_MOUNT_KEY, None)
    try:
        root = resolve_root(*known, shared_mount=mount is not None and mount.lower() == "true")
    except RuntimeError:
        folder = known[0] or known[1]
        if not folder or mount is not None or not seen_by_all(spark, folder):
            raise
        spark.conf.set(SHARED_MOUNT_KEY, "true")
        root = resolve_root(*known, shared_mount=True)
    if root is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="loglens-"))
        root = spark.sparkContext.getCheckpointDir()
    if spark.conf.get(_ROOT_KEY, None) != root:
        spark.conf.set(_ROOT_KEY, root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared root (never reused)."""
    name = "-".join(parts + (uuid.uuid4().hex[:12],))
    return f"{shared_root(spark)}/{name}"
