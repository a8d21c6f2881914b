"""Client, product and country analytics."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from storeloom.functions.calendar import days_between
from storeloom.functions.numeric import (cents, cents_to_money, from_cents, ratio,
                                         round2)
from storeloom.functions.selection import exact_median
from storeloom.operators.facts import CLIENT_ATTRIBUTES
from storeloom.operators.quality import top_k_per_group

ACTIVE_DAYS = 90

__all__ = ["client_totals", "client_recency_frequency", "client_activity_flag",
           "client_high_value_flag", "client_kpis", "product_totals", "top_k_per_group",
           "product_top_countries", "product_top_countries_join", "product_analytics",
           "country_totals", "market_share", "country_analytics", "purchase_aggregates"]


def purchase_aggregates(purchases: DataFrame) -> DataFrame:
    """Order count, spend, order values, quantity and date span per client.

    Only fixed-width buffers, so this is a hash aggregation that combines on
    the map side: a client with a third of all rows sends one row per task.
    """
    return purchases.groupBy("id_client").agg(
        F.count("id_purchase").alias("total_purchases"),
        F.sum(cents("total")).alias("spent_cents"),
        F.min("total").alias("min_order_value"),
        F.max("total").alias("max_order_value"),
        F.sum(F.col("quantity").cast("bigint")).alias("total_quantity"),
        F.min("purchase_date").alias("first_purchase_date"),
        F.max("purchase_date").alias("last_purchase_date"))


def client_totals(purchases: DataFrame, clients: DataFrame) -> DataFrame:
    """Purchase aggregates of each buying client with the client's attributes.

    Aggregating before the join keeps the join at client grain and free of
    skew; the aggregate is already partitioned by the join key.
    """
    spent = F.col("spent_cents")
    return (purchase_aggregates(purchases)
            .join(clients.select("id_client", *CLIENT_ATTRIBUTES), "id_client", "left")
            .select("id_client", "total_purchases",
                    cents_to_money(spent).alias("total_spent"),
                    ratio(from_cents(spent), F.col("total_purchases")).alias("avg_order_value"),
                    "min_order_value", "max_order_value", "total_quantity",
                    "first_purchase_date", "last_purchase_date", *CLIENT_ATTRIBUTES))


def purchases_per_month(orders: Column, lifetime_days: Column) -> Column:
    """Orders per 30 days of lifetime, a lifetime below one month counting as one."""
    return orders / F.greatest(lifetime_days / F.lit(30.0), F.lit(1.0))


def client_recency_frequency(totals: DataFrame, as_of: date) -> DataFrame:
    today = F.lit(as_of)
    lifetime = days_between(today, F.col("first_purchase_date"))
    return totals.withColumns({
        "customer_lifetime_days": lifetime,
        "purchase_frequency_per_month": round2(
            purchases_per_month(F.col("total_purchases"), lifetime)),
        "days_since_last_purchase": days_between(today, F.col("last_purchase_date")),
    })


def client_activity_flag(kpis: DataFrame) -> DataFrame:
    return kpis.withColumn("is_active", F.col("days_since_last_purchase") <= ACTIVE_DAYS)


def client_high_value_flag(kpis: DataFrame, approx: bool = False,
                           spend: DataFrame | None = None) -> DataFrame:
    """Spend above the median of all clients.

    The median is a scalar subquery. ``spend`` may name a frame that already
    holds every client's ``total_spent``, such as a written table.
    """
    median = exact_median(kpis if spend is None else spend, "total_spent", approx).scalar()
    return kpis.withColumn("is_high_value", F.col("total_spent").cast("double") > median)


def client_kpis(purchases: DataFrame, clients: DataFrame, as_of: date,
                approx: bool = False) -> DataFrame:
    spend = purchase_aggregates(purchases).select(
        cents_to_money(F.col("spent_cents")).alias("total_spent"))
    return kpis_from_totals(client_totals(purchases, clients), as_of, approx, spend)


def kpis_from_totals(totals: DataFrame, as_of: date, approx: bool = False,
                     spend: DataFrame | None = None) -> DataFrame:
    """The KPIs from per-client totals; ``spend`` as in the high-value flag."""
    source = totals if spend is None else spend
    return (totals
            .transform(lambda t: client_recency_frequency(t, as_of))
            .transform(client_activity_flag)
            .transform(lambda t: client_high_value_flag(t, approx, spend=source)))


def product_totals(sales: DataFrame) -> DataFrame:
    """Quantity, revenue, price span, orders and distinct clients per product.

    The distinct count is planned as a first aggregation on (product, client),
    which spreads a dominant product over all tasks.
    """
    orders = F.count("id_purchase")
    quantity = F.sum(F.col("quantity").cast("bigint"))
    return sales.groupBy("product").agg(
        quantity.alias("total_quantity_sold"),
        from_cents(F.sum(cents("total"))).alias("total_revenue"),
        ratio(from_cents(F.sum(cents("price"))), F.count("price")).alias("avg_price"),
        F.min("price").cast("double").alias("min_price"),
        F.max("price").cast("double").alias("max_price"),
        orders.alias("total_orders"),
        F.countDistinct("id_client").alias("unique_customers"),
        ratio(quantity, orders).alias("avg_quantity_per_order"))


def product_country_revenue(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("product", "country")
            .agg(F.sum(cents("total")).alias("revenue_cents"))
            .select("product", "country", from_cents(F.col("revenue_cents")).alias("revenue")))


def product_top_countries(fact: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` best countries of each product in one string, best first."""
    best = top_k_per_group(product_country_revenue(fact).where(F.col("country").isNotNull()),
                           ["product"], [F.col("revenue").desc(), F.col("country")], k)
    names = F.expr("listagg(country, ', ') within group (order by rank)")
    return best.groupBy("product").agg(names.alias("top_countries"))


def product_top_countries_join(totals: DataFrame, countries: DataFrame) -> DataFrame:
    return totals.join(countries, "product", "left")


def product_analytics(fact: DataFrame, k: int = 3) -> DataFrame:
    """Totals and best countries per product, from one scan and one large shuffle.

    The fact is first aggregated by product, country and client, which spreads a
    dominant product and a dominant client and leaves nothing to count twice: a
    client has one country, so its rows are the distinct clients.
    """
    per_client = fact.groupBy("product", "country", "id_client").agg(
        F.count("id_purchase").alias("orders"), F.sum(F.col("quantity").cast("bigint")).alias("quantity"),
        F.sum(cents("total")).alias("revenue"), F.sum(cents("price")).alias("prices"),
        F.count("price").alias("priced"), F.min("price").alias("low"), F.max("price").alias("high"))
    sums = [F.sum(c).alias(c) for c in ("orders", "quantity", "revenue", "prices", "priced")]
    ends = [F.min("low").alias("low"), F.max("high").alias("high")]
    per_country = per_client.groupBy("product", "country").agg(*sums, *ends, F.count("id_client").alias("clients"))
    # A few countries per product from here on.
    place = Window.partitionBy("product").orderBy(
        F.col("country").isNull(), from_cents(F.col("revenue")).desc(), "country")
    ranked = per_country.withColumn("rank", F.row_number().over(place))
    names = F.expr(f"listagg(CASE WHEN rank <= {k} THEN country END, ', ') within group (order by rank)")
    out = ranked.groupBy("product").agg(*sums, *ends, F.sum("clients").alias("clients"),
                                        names.alias("top_countries"))
    return out.select(
        "product", F.col("quantity").alias("total_quantity_sold"), from_cents(F.col("revenue")).alias("total_revenue"),
        ratio(from_cents(F.col("prices")), F.col("priced")).alias("avg_price"),
        F.col("low").cast("double").alias("min_price"), F.col("high").cast("double").alias("max_price"),
        F.col("orders").alias("total_orders"), F.col("clients").alias("unique_customers"),
        ratio(F.col("quantity"), F.col("orders")).alias("avg_quantity_per_order"), "top_countries",
    ).orderBy(F.col("total_revenue").desc(), F.col("product"))

def country_totals(totals: DataFrame) -> DataFrame:
    """Revenue, clients, orders and quantity per country.

    Input is one row per client (``client_totals``): a client has one country,
    so distinct clients are a plain count and the sales are not read again.
    """
    revenue = from_cents(F.sum(cents("total_spent")))
    orders = F.sum("total_purchases")
    clients = F.count("id_client")
    return totals.groupBy("country").agg(
        revenue.alias("total_revenue"),
        clients.alias("unique_customers"),
        orders.alias("total_orders"),
        F.sum("total_quantity").alias("total_quantity"),
        ratio(revenue, orders).alias("avg_order_value"),
        ratio(revenue, clients).alias("avg_revenue_per_customer"))


def market_share(countries: DataFrame) -> DataFrame:
    """Percent of the grand total; the window sees one row per country."""
    grand = F.sum(cents("total_revenue")).over(Window.partitionBy())
    share = F.try_divide(F.col("total_revenue"), from_cents(grand)) * 100
    return countries.withColumn("market_share_pct", round2(share))


def country_analytics(totals: DataFrame) -> DataFrame:
    return (country_totals(totals).transform(market_share)
            .orderBy(F.col("total_revenue").desc(), F.col("country")))
