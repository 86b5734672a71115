"""Session settings the library relies on or runs best with."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Dates and timestamps of text are read in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A wide cast makes a generated method that HotSpot would leave uncompiled (over 8000
    # bytes); beyond that size the plain projection, which is split up, is faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
