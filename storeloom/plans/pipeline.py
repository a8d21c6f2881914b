"""The whole run: bronze, silver and, unless switched off, gold."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from storeloom.layout import Layout
from storeloom.plans.gold import gold_flow
from storeloom.plans.silver import silver_flow
from storeloom.sources.files import bronze_ingest


def run_pipeline(spark: SparkSession, data_dir: str, layout: Layout, as_of: date,
                 include_gold: bool = True, if_absent: bool = False, min_quantity: int = 0,
                 approx: bool = False, export_csv: bool = True) -> dict[str, object]:
    """Run the layers in one session.

    Returns the bronze and silver tables and, with gold, its summary rows.
    """
    out: dict[str, object] = {
        "bronze": bronze_ingest(spark, data_dir, layout, if_absent),
        "silver": silver_flow(spark, layout, as_of, min_quantity, export_csv),
    }
    if include_gold:
        out["gold"] = gold_flow(spark, layout, as_of, approx, export_csv=export_csv)
    return out


def summary_of(result: dict[str, object]) -> DataFrame:
    summary = result.get("gold")
    if not isinstance(summary, DataFrame):
        raise ValueError("the run was made without gold")
    return summary
