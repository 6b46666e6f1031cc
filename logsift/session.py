"""Session helpers: a local session for tests and the shared scratch folder.

On a cluster the session comes from the caller; the library only reads
``spark.checkpoint.dir`` from it (a shared folder every executor sees) and
never falls back to a machine-local folder unless the setting is absent,
which only happens in local tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_CKPT: str | None = None


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench (``local[cores]``, UI off, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("logsift")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Settings the library relies on: UTC wall clock for log times.

    Log lines carry naive local times (the zone offset is dropped, as the
    reference does), so the session zone must be UTC for text <-> timestamp
    round trips to be the identity.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; set one under /tmp only when unset (tests)."""
    global _LOCAL_CKPT
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current.rstrip("/")
    if not sc.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _LOCAL_CKPT is None:
        _LOCAL_CKPT = tempfile.mkdtemp(prefix="logsift-ckpt-", dir="/tmp")
    sc.setCheckpointDir(_LOCAL_CKPT)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder (never reused)."""
    base = checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    path = f"{base}/scratch/{name}-{uuid.uuid4().hex[:12]}"
    if "://" not in path:
        os.makedirs(os.path.dirname(path), exist_ok=True)
    return path
