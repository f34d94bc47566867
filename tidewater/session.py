"""Session with the settings that the library's results rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def session(name: str = "tidewater", **more: str) -> SparkSession:
    """A session in UTC with adaptive execution; more: further settings, with __ for dots."""
    builder = SparkSession.builder.appName(name)
    for key, value in (SETTINGS | {k.replace("__", "."): v for k, v in more.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
