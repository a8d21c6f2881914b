"""Silver to gold: fact, KPIs, analytics, series, statistics and summary."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from storeloom.layout import Layout
from storeloom.operators import facts, kpis, stats, temporal
from storeloom.plans.parallel import run_together
from storeloom.plans.silver import read_silver
from storeloom.schemas import GOLD_TABLES
from storeloom.sources import sinks

STATISTICS_SECTIONS = {
    "order_value_distribution": ["mean", "median", "std", "min", "max", "q25", "q75", "q90", "q95"],
    "quantity_distribution": ["mean", "median", "mode", "min", "max"],
    "price_distribution": ["mean", "median", "std", "min", "max"],
    "overall_metrics": ["total_revenue", "total_orders", "total_customers", "total_products",
                        "total_countries", "avg_order_value", "avg_items_per_order"],
}
SUMMARY_SECTIONS = {
    "fact_table": ["total_rows", "date_min", "date_max"],
    "kpis": ["total_clients", "total_products", "total_countries", "active_clients",
             "high_value_clients"],
    "temporal_aggregations": ["daily_records", "weekly_records", "monthly_records"],
    "top_performers": ["top_product_by_revenue", "top_country_by_revenue",
                       "top_client_by_spending"],
}


def build(clients: DataFrame, purchases: DataFrame, as_of: date, approx: bool = False,
          week_style: str = "iso") -> dict[str, DataFrame]:
    """All gold tables as lazy frames.

    Each table reads the narrowest input that can answer it: the series read
    purchases, client and country tables read purchases aggregated per
    client, and only the fact and the product ranking join sales to clients.
    """
    fact = facts.fact_sales(purchases, clients, week_style)
    totals = kpis.client_totals(purchases, clients)
    return {
        "fact_sales": fact,
        "client_kpis": kpis.client_kpis(purchases, clients, as_of, approx),
        "product_analytics": kpis.product_analytics(fact),
        "country_analytics": kpis.country_analytics(totals),
        "daily_sales": temporal.daily_sales(purchases),
        "weekly_sales": temporal.weekly_sales(purchases, week_style),
        "monthly_sales": temporal.monthly_sales(purchases),
    }


def read_gold(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(layout.path("gold", t)) for t in GOLD_TABLES}


def summary_report(rows: DataFrame, layout: Layout) -> DataFrame:
    """The summary rows as one nested row: whole numbers, a date range and the paths."""
    row = sinks.report_row(rows, SUMMARY_SECTIONS)

    def counts(section: str) -> Column:
        return F.struct(*[F.col(f"{section}.{m}").cast("bigint").alias(m)
                          for m in SUMMARY_SECTIONS[section]])

    dates = F.struct(F.col("fact_table.date_min").alias("min"),
                     F.col("fact_table.date_max").alias("max"))
    files = {t: layout.path("gold", t) for t in GOLD_TABLES}
    files["statistical_distributions"] = layout.export("gold", "statistical_distributions", "json")
    return row.select(
        F.struct(F.col("fact_table.total_rows").cast("bigint").alias("total_rows"),
                 dates.alias("date_range")).alias("fact_table"),
        counts("kpis").alias("kpis"),
        counts("temporal_aggregations").alias("temporal_aggregations"),
        "top_performers",
        F.struct(*[F.lit(p).alias(t) for t, p in files.items()]).alias("files_created"))


def gold_flow(spark: SparkSession, layout: Layout, as_of: date, approx: bool = False,
              week_style: str = "iso", export_csv: bool = True) -> DataFrame:
    """Write every gold table and report; return the summary rows.

    The fact and the per-client totals feed several tables, so they are
    written first and read back: the tables after them scan a few columns of
    Parquet instead of repeating joins, nothing is held in executor memory,
    and a lost executor costs one task, not the lineage.
    """
    silver = read_silver(spark, layout)
    clients, purchases = silver["clients"], silver["purchases"]
    fact_path = layout.path("gold", "fact_sales")
    totals_path = layout.path("gold", "client_totals")

    # Writing by year sorts by it anyway; with the purchases of a client side by side files and later shuffles are smaller.
    order = ["purchase_year", "id_client", "id_purchase"]
    run_together(spark, [
        lambda: sinks.write_parquet(facts.fact_sales(purchases, clients, week_style).sortWithinPartitions(*order),
                                    fact_path, partition_by=["purchase_year"]),
        lambda: sinks.write_parquet(kpis.client_totals(purchases, clients), totals_path),
    ])
    fact, totals = spark.read.parquet(fact_path), spark.read.parquet(totals_path)

    derived = {
        "client_kpis": kpis.kpis_from_totals(totals, as_of, approx),
        "product_analytics": kpis.product_analytics(fact),
        "country_analytics": kpis.country_analytics(totals),
        "daily_sales": temporal.daily_sales(fact),
        "weekly_sales": temporal.weekly_sales(fact, week_style),
        "monthly_sales": temporal.monthly_sales(fact),
    }

    def statistics() -> None:
        long = stats.statistical_distributions(fact, approx)
        sinks.write_json_report(sinks.report_row(long, STATISTICS_SECTIONS),
                                layout.export("gold", "statistical_distributions", "json"))

    def export(table: str) -> None:
        sinks.write_csv(spark.read.parquet(layout.path("gold", table)),
                        layout.export("gold", table, "csv"))

    # The longest jobs first, so that short ones fill the rest.
    jobs = [statistics]
    if export_csv:
        jobs.append(lambda: export("fact_sales"))
    jobs += [lambda t=t, d=d: sinks.write_parquet(d, layout.path("gold", t))
             for t, d in derived.items()]
    run_together(spark, jobs)

    summary = stats.gold_summary(read_gold(spark, layout))
    jobs = [lambda: sinks.write_json_report(summary_report(summary, layout),
                                            layout.export("gold", "gold_summary", "json"))]
    if export_csv:
        jobs += [lambda t=t: export(t) for t in derived]
    run_together(spark, jobs)
    return summary
