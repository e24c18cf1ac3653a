"""Session defaults of single-machine runs."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

from recordloom.sources.scan import FEED_PARTITIONS


def local_session(cpus: int | str = 8, app: str = "recordloom") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config(FEED_PARTITIONS, str(cpus))
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_LOCAL_DIR: dict[str, str] = {}


def run_folder(spark: SparkSession, tag: str) -> str:
    """A new folder of this run below ``spark.checkpoint.dir``; below a temporary folder where that is unset in local mode, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL_DIR:
            _LOCAL_DIR[app] = tempfile.mkdtemp(prefix="spark-")
        base = "file://" + _LOCAL_DIR[app]
    return f"{base.rstrip('/')}/recordloom-{tag}-{uuid.uuid4().hex}"
