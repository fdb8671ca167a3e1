"""Session settings and the shared working folder.

The library never assumes a machine-local folder on a cluster: scratch output
(test landings, checkpoints that cut lineage) goes under the folder named by
``spark.checkpoint.dir``.  Only when that setting is missing in local mode
(tests) do we create one under the system temp folder; on a cluster it is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every model relies on.  Timestamps are stored as TIMESTAMP_NTZ
# (wall-clock trip times), so the session zone only matters for display, but
# UTC keeps any LTZ conversion a no-op.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Checkpoint files go as soon as no DataFrame refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "farelane", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the benchmark."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="farelane-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    # SparkContext appends a random sub-folder; hand back the one it uses.
    return sc.getCheckpointDir() or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "farelane", f"{name}-{uuid.uuid4().hex[:12]}")


def scale_conf(input_bytes: int, cores: int, partition_bytes: int = 256 << 20) -> dict:
    """Settings sized for a given input volume on a cluster with ``cores`` task slots.

    * shuffle partitions: enough that each holds about ``partition_bytes`` of
      input (at least 2 waves of tasks); AQE coalesces small ones at run time
      and splits skewed ones (a key with a third of the rows) for joins;
    * scan splits of ``partition_bytes`` so each task reads a bounded slice;
    * the broadcast threshold stays small, and the runtime threshold lets
      AQE turn a join into a broadcast only after measuring a side.
    """
    parts = max(2 * cores, -(-int(input_bytes) // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(32 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
    }


def apply_scale_conf(spark: SparkSession, input_bytes: int, cores: int) -> dict:
    """Opt-in: set the :func:`scale_conf` values on a running session.

    Only run-time SQL settings are changed; a setting the cluster fixes at
    start-up is left alone.
    """
    applied = {}
    for k, v in scale_conf(input_bytes, cores).items():
        try:
            spark.conf.set(k, v)
            applied[k] = v
        except Exception:  # noqa: BLE001 - static settings cannot change at run time
            pass
    return applied
