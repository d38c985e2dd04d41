"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session gets. ANSI stays on (casts that may fail use
# try_cast explicitly); AQE re-plans shuffles at runtime, coalesces small
# partitions and splits skewed join partitions.
_DEFAULTS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "brightwash",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    partition_mb: int | None = None,
) -> SparkSession:
    """Return a session with the engine defaults.

    ``master`` is only set for local runs; on a cluster the launcher decides.

    Sizing for large inputs: ``shuffle_partitions`` is the initial number of
    shuffle partitions; pick it so that the largest shuffle (bytes after the
    map-side partial aggregate, e.g. the review dedup) gives about
    ``partition_mb`` per partition, i.e. it fits one executor core's
    execution memory. AQE then merges partitions down to ``partition_mb``
    (``advisoryPartitionSizeInBytes``) and splits skewed ones, so a generous
    initial number costs little. ``partition_mb`` also sets the scan split
    size (``maxPartitionBytes``).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if partition_mb:
        conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = f"{partition_mb}m"
        conf["spark.sql.files.maxPartitionBytes"] = f"{partition_mb}m"
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Private folder of this process, used only when no checkpoint dir is set.
_LOCAL_ROOT: str | None = None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``, read from the session
    (this also works for Spark Connect clients). When nothing is configured, a
    local master gets a private temporary folder; any other raises.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext in a Connect client
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder that all executors share: "
            "a temporary folder of the driver cannot hold intermediate tables on a cluster"
        )
    global _LOCAL_ROOT
    if _LOCAL_ROOT is None:
        _LOCAL_ROOT = tempfile.mkdtemp(prefix="brightwash-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(_LOCAL_ROOT)
        return sc.getCheckpointDir() or _LOCAL_ROOT
    return _LOCAL_ROOT


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")
