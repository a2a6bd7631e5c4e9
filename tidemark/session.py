"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import contextlib
import os
import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Large pages: keep a handful of big rows per batch.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tidemark", extra: dict | None = None) -> SparkSession:
    """Session with the defaults above (used by tests and bench; clusters bring their own)."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextlib.contextmanager
def _set(spark: SparkSession, key: str, value: str):
    was = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, was)


def shuffles_dropped(spark: SparkSession):
    """Tables written inside leave no shuffle files behind: they go as soon as a table is written.

    Otherwise they stay until the driver happens to collect its garbage, and the
    steps of a long query add up on disk.
    """
    return _set(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def dealt_by_one_key(spark: SparkSession):
    """Joins planned inside take sides that are both dealt by one of the join keys as they are, without dealing them again by all."""
    return _set(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting is always used.  Only in local mode, when nothing
    is configured (tests), a fresh scratch folder is created; on a cluster a
    missing setting is an error, never a machine-local folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: only the configured folder can be used
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    path = tempfile.mkdtemp(prefix="tidemark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()
