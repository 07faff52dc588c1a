"""Session settings for tests, benchmarks and stand-alone use. Library functions never start or change a session."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.host": "127.0.0.1",
}


def local_session(cpus: int = 8, partitions: int = 8, memory: str = "8g", **more: str) -> SparkSession:
    """A session on one machine; ``more`` are extra settings with dots written as double underscores."""
    builder = SparkSession.builder.master(f"local[{cpus}]").config("spark.driver.memory", memory)
    builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in more.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
