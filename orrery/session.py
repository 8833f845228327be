"""Sessions with the settings that the plans of this package expect."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "orrery", master: str | None = None, **conf: str) -> SparkSession:
    """A session with AQE, skew joins and ANSI mode on and UTC times; `conf` (dots as double underscores) overrides."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
