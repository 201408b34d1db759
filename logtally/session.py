"""A session for the command line or a notebook; every function in the package takes any session just as well."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession


def build_session(
    app_name: str,
    master: str | None = None,
    *,
    warehouse_dir: str | None = None,
    metastore_uri: str | None = None,
    shuffle_partitions: int | None = None,
    fair_scheduling: bool = False,
    config: Mapping[str, str] | None = None,
) -> SparkSession:
    """Get or create a session. With a metastore URI the catalog is Hive's.

    Memory, serializer and parallelism are left to the submit command, where they take effect.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.sql.session.timeZone", "UTC")
    if master:
        builder = builder.master(master)
    if warehouse_dir:
        builder = builder.config("spark.sql.warehouse.dir", warehouse_dir)
    if metastore_uri:
        builder = builder.config("hive.metastore.uris", metastore_uri).enableHiveSupport()
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if fair_scheduling:
        builder = builder.config("spark.scheduler.mode", "FAIR")
    for key, value in (config or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
