"""Session helpers for tests, the bench and local runs.

On a cluster the session comes from the platform; these helpers only fill in
settings that are *unset* so they never override cluster configuration.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_spark(app: str = "shelfscope", cpus: int | str | None = None,
              shuffle_partitions: int | None = None,
              driver_memory: str = "16g", checkpoint_dir: str | None = None) -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS") or "*"
    parts = shuffle_partitions or (int(cpus) if str(cpus).isdigit() else os.cpu_count() or 8)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_base(spark: SparkSession) -> str:
    """The shared folder that the session names; there is no local fallback."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise RuntimeError("spark.checkpoint.dir is not set: no shared folder to write to")
    return base.rstrip("/")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors as a zip, for clusters where it is not installed
    (its pandas UDFs import it there)."""
    import shutil
    import tempfile

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(), "shelfscope"), "zip", root, "shelfscope"))
