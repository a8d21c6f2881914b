"""Bronze to silver: clean both tables and write the quality report."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from storeloom.layout import Layout
from storeloom.operators import silver
from storeloom.operators.quality import NULL_TOKENS, tokens_to_null
from storeloom.plans.parallel import run_together
from storeloom.schemas import SILVER
from storeloom.session import through_table
from storeloom.sources import sinks
from storeloom.sources.files import read_bronze

def read_silver_table(spark: SparkSession, layout: Layout, table: str) -> DataFrame:
    return spark.read.schema(SILVER[table]).parquet(layout.path("silver", table))


def read_silver(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    return {t: read_silver_table(spark, layout, t) for t in SILVER}


def silver_flow(spark: SparkSession, layout: Layout, as_of: date, min_quantity: int = 0,
                export_csv: bool = True,
                null_tokens: Sequence[str] = tuple(NULL_TOKENS)) -> dict[str, DataFrame]:
    """Write silver clients, purchases and ``quality_report``; return the two tables.

    Bronze keeps texts such as ``N/A``; they count as missing from here on.
    """
    bronze = {t: tokens_to_null(df, null_tokens) for t, df in read_bronze(spark, layout).items()}
    # Each bronze table is read and parsed once; the clean table and its report share the tagged rows.
    tagged_clients, tagged_purchases = run_together(spark, [
        lambda: through_table(silver.tag_clients(bronze["clients"], as_of), "tagged-clients"),
        lambda: through_table(silver.tag_purchases(bronze["purchases"], as_of, min_quantity), "tagged-purchases")])
    sinks.write_parquet(silver.clean_tagged_clients(tagged_clients), layout.path("silver", "clients"))
    clients = read_silver_table(spark, layout, "clients")

    def purchases() -> None:
        sinks.write_parquet(silver.clean_tagged_purchases(tagged_purchases, clients),
                            layout.path("silver", "purchases"))

    def report() -> None:
        row = silver.quality_report(silver.tagged_client_quality_row(tagged_clients),
                                    silver.tagged_purchase_quality_row(tagged_purchases, clients))
        sinks.write_json_report(row, layout.export("silver", "quality_report", "json"),
                                stamp="report_timestamp")

    def export(table: str) -> None:
        sinks.write_csv(read_silver_table(spark, layout, table),
                        layout.export("silver", table, "csv"))

    exports = [lambda: export("clients")] if export_csv else []
    run_together(spark, [purchases, report, *exports])
    if export_csv:
        export("purchases")
    return read_silver(spark, layout)
