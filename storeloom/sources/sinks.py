"""Writing layer tables, text exports and reports."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F

from storeloom.operators.quality import format_dates
from storeloom.session import COMPRESSION

ENGINE = "spark"


def write_csv(df: DataFrame, path: str) -> str:
    """A header CSV directory; dates as ``yyyy-MM-dd``, text kept as it is."""
    (format_dates(df).write.mode("overwrite")
     .option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))
    return path


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                  bloom_columns: Sequence[str] = ()) -> str:
    writer = df.write.mode("overwrite")
    for column in bloom_columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path, compression=COMPRESSION)
    return path


def report_row(long: DataFrame, sections: dict[str, Sequence[str]]) -> DataFrame:
    """One row with a struct per section from ``(section, metric, value)`` rows."""
    def cell(section: str, metric: str):
        here = (F.col("section") == section) & (F.col("metric") == metric)
        return F.max(F.when(here, F.col("value"))).alias(metric)

    return long.agg(*[F.struct(*[cell(s, m) for m in metrics]).alias(s)
                      for s, metrics in sections.items()])


def write_json_report(row: DataFrame, path: str, stamp: str = "generated_at",
                      at: str | None = None) -> str:
    """A one-row frame as a JSON report with its time and engine.

    One row is one file, so the single partition is right here.
    """
    moment = at or datetime.now(timezone.utc).isoformat()
    (row.withColumns({stamp: F.lit(moment), "processing_engine": F.lit(ENGINE)})
     .coalesce(1).write.mode("overwrite").json(path))
    return path
