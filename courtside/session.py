"""Session settings the operators are meant to run with."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Window bounds and calendar days are UTC.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: joins by real sizes, split skewed partitions, merge small ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM never compiles methods beyond this size; without whole-stage code such
    # stages (score lines, message decoding) are cut into small methods, which it does.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark
