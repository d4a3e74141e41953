"""Spark session defaults shared by the bench, the tests and interactive use."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Only settings that matter for every job; anything tied to a cluster's size
# (shuffle partitions, memory, checkpoint folder) is left to the submitter.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "voltline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library defaults; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession) -> str:
    """A new folder that all machines share: under spark.checkpoint.dir, else the warehouse; a temporary one in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and spark.conf.get("spark.master", "local").startswith("local"):
        return f"file://{tempfile.mkdtemp(prefix='spark-')}"
    return f"{(root or spark.conf.get('spark.sql.warehouse.dir')).rstrip('/')}/voltline-{uuid.uuid4().hex}"
