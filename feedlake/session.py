"""Session settings that the library's operators rely on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_session(app: str = "feedlake", master: str | None = None) -> SparkSession:
    """A session with UTC time, adaptive execution and Arrow transfer; an existing session is reused."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def local_session(cores: int | None = None, memory: str = "8g") -> SparkSession:
    """The session used by tests and the benchmark: one JVM, as many shuffle partitions as cores."""
    n = cores or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{n}]")
        .appName("feedlake-local")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
