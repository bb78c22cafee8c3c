"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app: str = "tidemark", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """A session with the settings the library expects.

    Skewed join sides are split at run time; `size_shuffles` sets the shuffle width.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update(conf or {})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


SHUFFLE_BYTES = 128 * 1024 * 1024


def size_shuffles(spark: SparkSession, input_bytes: int, growth: float = 4.0) -> int:
    """Widen shuffles to the input, so that a shuffle partition stays near SHUFFLE_BYTES.

    `growth` allows for compressed columns turning into rows. The setting is only raised, and
    adaptive execution merges the partitions that stay small.
    """
    setting = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    now = int(spark.conf.get(setting, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = int(input_bytes * growth / SHUFFLE_BYTES) + 1
    if wanted > now:
        spark.conf.set(setting, str(wanted))
    return max(now, wanted)


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Queries started within lose their shuffle files as they end, not only when the driver happens to collect garbage.

    For many writes in a row, whose shuffles would add up on the executors' disks.
    """
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a purely local session without that setting gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by the cluster")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
    return _LOCAL_ROOTS[context.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder path under the shared root (not created yet)."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
