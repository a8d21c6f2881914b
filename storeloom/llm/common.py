"""Helpers the operators share: scratch tables and the text column."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where it is unset, one below the warehouse.

    Both are shared by the driver and all executors.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch").rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read back.

    It cuts the lineage, fixes row ids and partition numbers, and survives the
    loss of executors.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def groups(sizes: Iterable[int], most: int = 1 << 20) -> Iterator[slice]:
    """Slices of rows of some ``most`` units together, so that a step's memory is bounded."""
    begun = held = stop = 0
    for stop, size in enumerate(sizes, start=1):
        held += size
        if held >= most:
            yield slice(begun, stop)
            begun, held = stop, 0
    if begun < stop:
        yield slice(begun, stop)
