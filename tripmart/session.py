"""Session settings and shared scratch space.

The caller (driver, job runner, test) owns the SparkSession. ``configure`` only sets
SQL runtime confs that the plans in this package rely on:

* session time zone pinned to UTC, so any TIMESTAMP (with local time zone) arithmetic is
  stable; trip timestamps themselves are kept as TIMESTAMP_NTZ (wall-clock, no zone).
* dynamic partition overwrite, so writing one period replaces only that period.
* adaptive execution with skew-join splitting and partition coalescing.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime confs above to ``spark`` and return it."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, as from a checkout
    that isn't installed; elsewhere the package is installed on the cluster."""
    root, environment = str(Path(__file__).parents[1]), spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def _checkpoint_base(spark: SparkSession) -> str:
    try:
        sc = spark.sparkContext
    except Exception:  # remote (Connect) sessions have no local SparkContext
        sc = None
    base = None
    if sc is not None:
        base = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = (sc.master if sc is not None else spark.conf.get("spark.master", "")) or ""
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: configure a shared folder (e.g. on the "
                "cluster's object store) for scratch tables and streaming checkpoints"
            )
        # Local mode only (tests, single machine): a temporary folder is shared by all tasks.
        base = tempfile.mkdtemp(prefix="tripmart-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(base)
            base = sc.getCheckpointDir() or base
        else:
            spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory under the cluster's shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir) from the session and
    sets one only when none is configured, so jobs never write to machine-local temp
    folders on a cluster.
    """
    return f"{_checkpoint_base(spark)}/{name}-{uuid.uuid4().hex[:12]}"
