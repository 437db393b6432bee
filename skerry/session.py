"""Session settings that the engine is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str = "local[*]", **conf: str) -> SparkSession:
    """A session with adaptive execution, ANSI mode and UTC; conf (dots as double underscores) is added."""
    builder = SparkSession.builder.master(master).appName("skerry")
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
