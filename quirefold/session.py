"""Session factory."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "quirefold", **conf: str) -> SparkSession:
    """A session with Arrow, adaptive execution and UTC; ``conf`` adds or overrides settings (dots as __)."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    builder = SparkSession.builder.appName(app)
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
