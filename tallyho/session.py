"""Session helpers: a local session for tests / bench, and the shared scratch area.

On a cluster the session is built by the platform; the library only reads
``spark.checkpoint.dir`` from it.  A private directory is created only when that
setting is missing and the master is local (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "tallyho", event_log_dir: str | None = None) -> SparkSession:
    """Local session for tests and the bench.  ``event_log_dir`` turns on Spark's
    event log there (stage and task times without the web UI)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    if event_log_dir:
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log_dir))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    master = spark.conf.get("spark.master", "") or ""
    return master.startswith("local")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written hand-over tables and streaming checkpoints.

    Taken from the session's checkpoint directory (``spark.checkpoint.dir``).
    When it is unset, a private folder is created, but only in local mode.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (sessions without a local SparkContext handle)
        sc = None
    root = (sc.getCheckpointDir() if sc is not None else None) or \
        spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a folder that every "
                "executor can reach (for example an object-store prefix)")
        root = tempfile.mkdtemp(prefix="tallyho-")
        if sc is not None:
            sc.setCheckpointDir(root)
            root = sc.getCheckpointDir() or root
    elif sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unique folder under the scratch root (never reused, never cleared)."""
    root = scratch_root(spark).rstrip("/")
    return f"{root}/tallyho/{label}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
