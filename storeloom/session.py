"""Session construction and the shared scratch location."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


#: Of all Parquet tables; every Parquet reader knows it, and files get some fifth smaller than by the default.
COMPRESSION = "zstd"


def build_session(app: str = "storeloom", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings the operators assume.

    ANSI mode and the standard date parser stay on, so bad input must go
    through ``try_*`` functions. AQE sizes the shuffle partitions and splits
    skewed join partitions at run time; the initial number only has to be
    large enough for the data, so it is left to the cluster's own setting.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the one in ``spark.checkpoint.dir``.

    Where it is unset, a folder below the warehouse, which executors share too.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def through_table(df, name: str):
    """Write ``df`` to the shared folder and read it back.

    Used where one expensive frame feeds several jobs. The written table
    cuts the lineage and survives the loss of executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=COMPRESSION)
    return df.sparkSession.read.schema(df.schema).parquet(path)
