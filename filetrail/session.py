"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Times are read, formatted and compared in UTC.
    "spark.sql.session.timeZone": "UTC",
    # The JVM compiles no method above 8000 bytes of bytecode, so wide records run far
    # faster as split projections than as one huge interpreted method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # For the same reason stages of records with more fields than this, flat ones included,
    # aren't fused at all: sorted for a write, they ran at half the speed even below the limit.
    "spark.sql.codegen.maxFields": "80",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
