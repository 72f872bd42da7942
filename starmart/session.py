"""Session settings for local runs; a cluster brings its own session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, **settings: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("starmart")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        # Call sites for error messages cost several round trips per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        # A hot key is split from this size on; the default of 256 MB suits executors.
        .config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "16MB")
        .config("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "3")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16MB")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
