"""Read queries over the gold or serving tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from storeloom.functions.numeric import cents, finite_or_null, from_cents, ratio

SERIES = {"daily": ("daily_sales", "date"),
          "weekly": ("weekly_sales", "week_start"),
          "monthly": ("monthly_sales", "month_start")}


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN and infinities of floating-point columns become NULL."""
    floats = [n for n, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({n: finite_or_null(F.col(n)) for n in floats}) if floats else df


def top_products(products: DataFrame, limit: int = 10) -> DataFrame:
    return products.orderBy(F.col("total_revenue").desc(), F.col("product")).limit(limit)


def countries_by_revenue(countries: DataFrame, limit: int | None = None) -> DataFrame:
    ordered = countries.orderBy(F.col("total_revenue").desc(), F.col("country"))
    return ordered if limit is None else ordered.limit(limit)


def top_clients(kpis: DataFrame, limit: int = 10, full_rows: bool = False) -> DataFrame:
    best = kpis.orderBy(F.col("total_spent").desc(), F.col("id_client")).limit(limit)
    if full_rows:
        return best
    return best.select("name", "country", "total_spent", "total_purchases", "last_purchase_date")


def recent_days(daily: DataFrame, days: int = 30) -> DataFrame:
    """The last ``days`` rows of the daily series, oldest first."""
    return daily.orderBy(F.col("date").desc()).limit(days).orderBy("date")


def global_kpis(daily: DataFrame, kpis: DataFrame) -> DataFrame:
    """Grand totals from the daily pre-aggregate, not from the fact."""
    clients = kpis.agg(F.count(F.lit(1)).alias("clients")).scalar()
    revenue = from_cents(F.sum(cents("total_revenue")))
    sums = daily.agg(revenue.alias("total_revenue"),
                     F.sum("total_orders").alias("total_orders"),
                     F.sum("total_quantity").alias("total_quantity"))
    return sums.select("total_revenue", "total_orders", "total_quantity",
                       clients.alias("total_customers"),
                       ratio(F.col("total_revenue"), F.col("total_orders")).alias("avg_order_value"))


def temporal_sales(tables: dict[str, DataFrame], period: str = "daily") -> DataFrame:
    if period not in SERIES:
        raise ValueError(f"period must be one of {', '.join(SERIES)}")
    table, key = SERIES[period]
    return tables[table].orderBy(key)


def client_distribution(kpis: DataFrame) -> DataFrame:
    active, high = F.count_if("is_active"), F.count_if("is_high_value")
    total = F.count(F.lit(1))
    return kpis.agg(total.alias("total"), active.alias("active"),
                    (total - active).alias("inactive"), high.alias("high_value"),
                    (total - high).alias("standard_value"))


def client_overview(kpis: DataFrame) -> DataFrame:
    spent = from_cents(F.sum(cents("total_spent")))
    frequency = from_cents(F.sum(cents("purchase_frequency_per_month")))
    return kpis.agg(F.count(F.lit(1)).alias("total_clients"),
                    F.count_if("is_active").alias("active_clients"),
                    ratio(spent, F.count("total_spent")).alias("avg_lifetime_value"),
                    ratio(frequency, F.count("purchase_frequency_per_month")).alias("avg_frequency"))


def serving_lookup(table: DataFrame, **keys) -> DataFrame:
    """Rows with the given key values, as pushed-down equality filters."""
    condition: Column | None = None
    for name, value in keys.items():
        test = F.col(name) == F.lit(value)
        condition = test if condition is None else condition & test
    if condition is None:
        raise ValueError("give at least one key")
    return table.where(condition)
