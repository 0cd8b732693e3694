"""Session settings the jobs run with, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# AQE sizes the reduce side, splits what is left of skew, and joins by hash instead of sorting the
# documents where every partition of the maps is small. Grouped ids stay in hash tables for more
# groups than by default before Spark turns to sorting.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.session.timeZone": "UTC",
}

_local_roots: dict[str, str] = {}


def build_session(app_name: str, **overrides: str) -> SparkSession:
    """A session with :data:`SETTINGS`; master, memory and storage come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a local one only on a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that every executor can reach")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="nestweave-")
    return _local_roots[context.applicationId]


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under :func:`shared_root`, never used before."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
