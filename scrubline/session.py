"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


# Whole-stage codegen emits one Java method per stage; HotSpot does not JIT a
# method over 8000 bytes, and the wide cleaning projection exceeds that.  With
# this limit Spark keeps whole-stage codegen where the code is small enough and
# uses compiled per-expression projections (small methods) elsewhere.
JIT_SAFE_CODEGEN = ("spark.sql.codegen.hugeMethodLimit", "8000")


def use_jit_safe_codegen(spark: SparkSession) -> None:
    """Apply ``JIT_SAFE_CODEGEN`` unless the session already sets a limit."""
    key, value = JIT_SAFE_CODEGEN
    if spark.conf.get(key, "65535") == "65535":
        spark.conf.set(key, value)


def local_session(cores: int | str = "*", app: str = "scrubline", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """A local-mode session configured the way the library expects.

    On a cluster the caller builds its own session; the library only relies on
    AQE being on (the Spark 4 default) and on ANSI mode (also default; every
    parse in the library uses ``try_*`` so bad cells become nulls, not errors).
    """
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SCRUBLINE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(*JIT_SAFE_CODEGEN)
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables and checkpoints.

    Uses the cluster's ``spark.checkpoint.dir`` when set.  Only when it is unset
    in local mode (tests, the bench) a fresh temporary folder is created and
    registered as the checkpoint directory; on a cluster an unset value is an
    error, never a machine-local folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not d:
        d = sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(written tables and stream checkpoints go there)")
        d = tempfile.mkdtemp(prefix="scrubline-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def new_run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder for one run's written tables."""
    return os.path.join(shared_dir(spark), f"scrubline-{name}-{uuid.uuid4().hex[:12]}")
