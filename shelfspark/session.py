"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# HotSpot never compiles methods above 8000 bytes of bytecode.  The wide rule projections
# exceed that as one fused stage method, so let Spark split them into smaller ones.
# An Arrow batch of pages becomes Python strings several times over (page, parts, texts); a small one keeps
# a worker's memory the same however many or long the pages are.
RUNTIME = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark
