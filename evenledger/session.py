"""A session with the settings this library expects; any session with the same settings works."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def session(app: str = "evenledger", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """UTC, adaptive execution with skew-join splitting. Master and sizes come from the caller or the cluster."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = (
            builder.master(master)
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()
