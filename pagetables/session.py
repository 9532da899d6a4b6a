"""Session settings the package relies on. Values a cluster has set itself are kept."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Plain tuning that suits page-sized rows; every key may be set differently by the user.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # JSON with a repeated key keeps the last value instead of being refused.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Pages are large: bound a batch handed to Python by rows as well as by bytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def build_session(master: str | None = None, app: str = "pagetables", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
