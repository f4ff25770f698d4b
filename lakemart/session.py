"""Session settings (C1-C5) and the shared folder for data written on the way."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.parquet.mergeSchema": "false",
}


def build_spark(
    master: str | None = None,
    shuffle_partitions: int = 0,
    conf: Mapping[str, str] | None = None,
    app_name: str = "lakemart",
) -> SparkSession:
    """Session with this library's defaults; ``conf`` wins over them.

    Catalog, object-store and memory settings come from the caller through
    ``conf`` or the cluster's own defaults. ``shuffle_partitions`` is applied
    only if positive: on a large cluster leave it to ``conf``, see the README.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    if shuffle_partitions > 0:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def drop_cached(spark: SparkSession) -> None:
    """Forget cached tables, as done before a timed run."""
    spark.catalog.clearCache()


def shared_folder(spark: SparkSession) -> str:
    """A new folder that every executor can reach.

    It lies under ``spark.checkpoint.dir`` or, where that is unset, in the
    warehouse, which tables are written to and read from anyway.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/lakemart-{uuid.uuid4().hex}"
