"""Session defaults for local runs."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, app: str = "gridloom") -> SparkSession:
    """A local session; on a cluster use the session the cluster gives."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("GRIDLOOM_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # call sites in error messages cost more than building the plan
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
