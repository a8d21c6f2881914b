"""Daily, weekly and monthly series.

Windows without a partition key run only here and only over one row per
period, never over sales.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from storeloom.functions import calendar as cal
from storeloom.functions.numeric import cents, from_cents, pct_change, ratio


def _totals() -> list[Column]:
    return [from_cents(F.sum(cents("total"))).alias("total_revenue"),
            F.count("id_purchase").alias("total_orders"),
            F.countDistinct("id_client").alias("unique_customers"),
            F.sum(F.col("quantity").cast("bigint")).alias("total_quantity")]


def daily_totals(sales: DataFrame) -> DataFrame:
    return sales.groupBy(F.col("purchase_date").alias("date")).agg(*_totals())


def weekly_totals(sales: DataFrame, week_style: str = "iso") -> DataFrame:
    weekly = sales.groupBy(cal.week_start(F.col("purchase_date")).alias("week_start")).agg(*_totals())
    return weekly.select(
        "week_start",
        cal.year_week(F.col("week_start"), week_style).alias("year_week"),
        "total_revenue", "total_orders", "unique_customers", "total_quantity",
        ratio(F.col("total_revenue"), F.col("total_orders")).alias("avg_order_value"))


def monthly_totals(sales: DataFrame) -> DataFrame:
    monthly = sales.groupBy(cal.month_start(F.col("purchase_date")).alias("month_start")).agg(*_totals())
    revenue = F.col("total_revenue")
    return monthly.select(
        "month_start",
        cal.year_month(F.col("month_start")).alias("year_month"),
        "total_revenue", "total_orders", "unique_customers", "total_quantity",
        ratio(revenue, F.col("total_orders")).alias("avg_order_value"),
        ratio(revenue, F.col("unique_customers")).alias("avg_revenue_per_customer"))


def rolling_7day(daily: DataFrame) -> DataFrame:
    """Trailing means over the last seven days that have sales (gaps stay gaps)."""
    last7 = Window.orderBy("date").rowsBetween(-6, 0)
    revenue = from_cents(F.sum(cents("total_revenue")).over(last7))
    rows = F.count(F.lit(1)).over(last7)
    return daily.withColumns({
        "revenue_7day_avg": ratio(revenue, rows),
        "orders_7day_avg": ratio(F.sum("total_orders").over(last7), rows),
    })


def growth(series: DataFrame, order: str, columns: dict[str, str]) -> DataFrame:
    """Percent change against the row before; ``columns`` maps source to result."""
    window = Window.orderBy(order)
    return series.withColumns({
        out: pct_change(F.col(c), F.lag(c).over(window)) for c, out in columns.items()})


def daily_growth(daily: DataFrame) -> DataFrame:
    return growth(daily, "date", {"total_revenue": "revenue_growth_pct"})


def weekly_growth(weekly: DataFrame) -> DataFrame:
    return growth(weekly, "week_start", {"total_revenue": "revenue_growth_pct"})


def monthly_growth(monthly: DataFrame) -> DataFrame:
    return growth(monthly, "month_start", {
        "total_revenue": "revenue_growth_pct",
        "total_orders": "orders_growth_pct",
        "unique_customers": "customers_growth_pct",
    })


def daily_sales(sales: DataFrame) -> DataFrame:
    return daily_totals(sales).transform(rolling_7day).transform(daily_growth).orderBy("date")


def weekly_sales(sales: DataFrame, week_style: str = "iso") -> DataFrame:
    return weekly_totals(sales, week_style).transform(weekly_growth).orderBy("week_start")


def monthly_sales(sales: DataFrame) -> DataFrame:
    return monthly_totals(sales).transform(monthly_growth).orderBy("month_start")
