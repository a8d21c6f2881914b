"""The denormalised sales fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from storeloom.functions import calendar as cal

CLIENT_ATTRIBUTES = ["name", "email", "country", "subscription_date"]


def fact_join(purchases: DataFrame, clients: DataFrame) -> DataFrame:
    """LEFT join of purchases with the client attributes.

    No broadcast hint: the client table grows with the business, so Spark
    compares its size with the broadcast threshold, and adaptive execution
    splits the partition of a client that holds many purchases.
    """
    return purchases.join(clients.select("id_client", *CLIENT_ATTRIBUTES), "id_client", "left")


def calendar_attributes(sales: DataFrame) -> DataFrame:
    """Year, month, quarter, ISO week, weekday (Monday = 0) and English day name."""
    day = F.col("purchase_date")
    return sales.withColumns({
        "purchase_year": F.year(day),
        "purchase_month": F.month(day),
        "purchase_quarter": F.quarter(day),
        "purchase_week": F.weekofyear(day),
        "purchase_day_of_week": F.weekday(day),
        "purchase_day_name": cal.day_name(day),
    })


def period_keys(sales: DataFrame, week_style: str = "iso") -> DataFrame:
    day = F.col("purchase_date")
    return sales.withColumns({
        "year_month": cal.year_month(day),
        "year_week": cal.year_week(day, week_style),
    })


def customer_tenure(sales: DataFrame) -> DataFrame:
    """Whole days from subscription to purchase; negative when bought before."""
    return sales.withColumn(
        "customer_tenure_days",
        cal.days_between(F.col("purchase_date"), F.col("subscription_date")))


def fact_sales(purchases: DataFrame, clients: DataFrame, week_style: str = "iso") -> DataFrame:
    return (fact_join(purchases, clients)
            .transform(calendar_attributes)
            .transform(lambda f: period_keys(f, week_style))
            .transform(customer_tenure))
