"""Session settings the operators are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE splits skewed join partitions and coalesces small ones, so the shuffle partition count is
# only an upper bound. Dates come from timestamps in several tables, hence the fixed zone.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Recording the Python line of every column expression slows down planning.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "cohortry", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the recommended settings; keyword keys use ``__`` for the dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    extra = {key.replace("__", "."): value for key, value in settings.items()}
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
