"""Session helper: sensible defaults for local runs and tests."""

from __future__ import annotations

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "8",
    "spark.driver.memory": "8g",
    # PySpark 4 records a Python call site for every Column function (four
    # extra driver round trips each) to enrich error messages; a plan with
    # hundreds of expressions pays seconds for it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", app: str = "bvengine", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (the UI stays off)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**LOCAL_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
