"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app_name: str = "streamgauge", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC, ANSI casts and AQE; ``conf`` overrides (dots as ``__``)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder named by ``spark.checkpoint.dir``.

    Where that is unset, the folder lies in the warehouse, which executors share, too.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    return f"{base}/{name}-{uuid.uuid4().hex}"


def materialize(df, name: str):
    """Write ``df`` once to the shared folder and return a scan of it.

    For results that several branches read, where recomputing costs more than
    a write. The written files survive the loss of executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
