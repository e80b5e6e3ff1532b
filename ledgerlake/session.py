"""Session settings and the shared work folder.

Everything in the package is lazy DataFrame code; this module only pins the
handful of session settings the semantics depend on (UTC, ANSI, AQE) and
finds the shared folder used for written intermediates and sinks.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the results depend on (time zone, ANSI arithmetic) or that the
# plans are designed around (AQE coalescing and skew-join splitting).
SESSION_SETTINGS: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

CHECKPOINT_CONF = "spark.checkpoint.dir"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that results depend on to an existing session."""
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        if spark.conf.get(key, None) != SESSION_SETTINGS[key]:
            spark.conf.set(key, SESSION_SETTINGS[key])
    return spark


def build_session(
    master: str = "local[*]",
    app_name: str = "ledgerlake",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for tests and local runs (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SESSION_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder for written intermediates: the cluster's ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and must be set. Only a local
    session without it gets a folder of its own, registered with the session.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if not configured:
        configured = spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"{CHECKPOINT_CONF} must name a shared folder on master {master!r}")
        configured = tempfile.mkdtemp(prefix="ledgerlake-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared folder for one write."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Writes of the block delete their shuffle files as they end, not when the driver next collects its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP_CONF, None)
    spark.conf.set(SHUFFLE_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP_CONF)
        else:
            spark.conf.set(SHUFFLE_CLEANUP_CONF, before)


def cluster_settings(total_cores: int, *, advisory_mb: int = 256) -> dict[str, str]:
    """Starting settings for a large cluster (e.g. 1000 executors, 100 TB).

    Shuffles start wide (3 tasks per core) and AQE coalesces them toward
    ``advisory_mb`` per task; skewed join partitions above 4x the advisory
    size and 5x the median are split; scans cut files into splits of the
    same size. Nothing here changes results.
    """
    mb = 1024 * 1024
    return {
        **SESSION_SETTINGS,
        "spark.sql.shuffle.partitions": str(max(200, 3 * total_cores)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(advisory_mb * mb),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * advisory_mb * mb),
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(advisory_mb * mb),
        "spark.sql.sources.partitionOverwriteMode": "static",  # dynamic only per write (S17/S18)
    }
