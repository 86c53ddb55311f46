"""Session settings that suit these jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Running word counts can outgrow the heap; keep them in RocksDB.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def builder(app_name: str = "textloom") -> SparkSession.Builder:
    """A session builder with the settings above; the master is left to the caller."""
    configured = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        configured = configured.config(key, value)
    return configured
