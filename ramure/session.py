"""Spark session settings and the shared work folder."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "ramure", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; `conf` (dots as `__`) overrides them.

    Shuffle parallelism is left to AQE: a high initial number of partitions that is coalesced to
    the advised size, so one setting serves a laptop and a cluster.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # the first n rows of a key are cut in each task, before the shuffle, for every n
        "spark.sql.optimizer.windowGroupLimitThreshold": str(2**31 - 1),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """A folder that the driver and all executors reach: the cluster's `spark.checkpoint.dir`, else the session's warehouse."""
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def spread(df: DataFrame, rows: int = 25_000) -> DataFrame:
    """The same rows, dealt evenly over tasks of about so many, however few files they were read from; counts them first."""
    count = df.count()
    return df.repartition(math.ceil(count / rows)) if count > rows else df


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table into a new folder of the work folder and go on from its files; lineage ends there."""
    folder = f"{work_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
