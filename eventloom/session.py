"""Session settings the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings that matter for results or for skewed data.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a hot case, state or value is split on the join's wide side, also where
    # that costs the join its output partitioning
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str = "eventloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with :data:`SETTINGS`; ``conf`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
