"""Session settings that the operators expect.  Nothing here is required for correct results."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "twinledger", master: str | None = None, **conf: str) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # joins on a person key may be skewed even where the next step reuses their partitioning
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()
