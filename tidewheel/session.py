"""The session that the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str | None = None, name: str = "tidewheel", **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; ``conf`` wins over these defaults."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    builder = SparkSession.builder.appName(name)
    builder = builder.master(master) if master else builder
    return builder.config(map=settings).getOrCreate()
