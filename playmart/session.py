"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    # event times are UTC; local wall time is computed explicitly
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # a hot join key is split over tasks at run time, even where that costs another shuffle
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a task writes to so many partitions at once without sorting its rows by them first
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


ROOT_CONF = "spark.playmart.scratch"


def configure(spark: SparkSession, root: str | None = None) -> SparkSession:
    """Apply the runtime settings the operators rely on to an existing session. ``root`` names the
    folder for checkpoints and scratch tables where the cluster names none."""
    if root and not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set(ROOT_CONF, root)
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints: the cluster's ``spark.checkpoint.dir``, else the folder that
    ``configure`` was given.

    Only a local session may fall back to a temporary folder of its own, which goes with it.
    """
    sc = spark.sparkContext
    root = (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(ROOT_CONF, None)
            or sc.getCheckpointDir())
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="playmart-checkpoint-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/playmart-{label}-{uuid.uuid4().hex[:12]}"
