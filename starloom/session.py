"""Session settings every operator relies on, and the shared scratch folder.

The driver hands us its own session, so nothing here builds one; ``configure``
sets the runtime SQL options on whatever session it is given.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Fixed runtime settings (see SURVEY §7.5):
#   zone-less calendar maths in UTC, ANSI casts that raise on overflow,
#   adaptive execution with skew-join splitting, and a CSV parser that checks
#   every column even when a query reads only some of them.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.csv.parser.columnPruning.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SESSION_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a local one only where none is set."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext, the setting is the folder
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not configured:
        # tests and local runs only: on a cluster this folder would be another one
        # on every executor
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor shares")
        configured = tempfile.mkdtemp(prefix="starloom-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for intermediate tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/starloom-{name}-{uuid.uuid4().hex[:12]}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


__all__ = ["configure", "checkpoint_dir", "scratch_path", "shuffle_partitions"]
