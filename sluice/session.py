"""Session construction and the shared work folder.

Jobs that must cut lineage or stage files write under the folder the cluster
names in ``spark.checkpoint.dir``.  Only when that setting is absent (a bare
local session, as in tests) do we create and register one of our own.
"""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Session settings the library relies on for exact, strict semantics.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = "local[*]", shuffle_partitions: int | None = 8,
                  app_name: str = "sluice", extra: dict | None = None) -> SparkSession:
    """Session with the settings the library relies on.  ``master=None`` leaves
    the master (and ``shuffle_partitions=None`` the partition count) to
    spark-submit / the cluster configuration."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``sluice`` importable in the Python workers (mapInPandas functions
    live in it): the package is zipped in memory, written to the shared work
    folder and registered with ``addPyFile`` -- once per application."""
    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # noqa: BLE001 - a session without a SparkContext: nothing to ship
        return
    if app in _SHIPPED:
        return
    from . import fs

    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(pkg):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    target = f"{work_root(spark)}/pyfiles-{uuid.uuid4().hex[:12]}/sluice.zip"
    fs.write_bytes(spark, target, buf.getvalue())
    sc.addPyFile(target)
    _SHIPPED.add(app)


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of input.

    Shuffle partitions start at about one per 256 MB of input (AQE then
    coalesces small ones and splits skewed ones), file splits are 512 MB, and
    a partition is skewed when it is 5x the median and above 512 MB.
    """
    partitions = max(200, input_bytes // target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(512 << 20),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        # Only a bare local session (tests) may use a folder of its own; on a cluster
        # every executor would write to its own disk.
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="sluice-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir().rstrip("/")


def work_root(spark: SparkSession) -> str:
    """Shared folder for staged tables, landing copies and stream checkpoints."""
    return ensure_checkpoint_dir(spark) + "/sluice-work"


def new_work_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never-reused folder under the shared work root."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
