"""Distribution statistics and the executive summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from storeloom.functions.numeric import cents, from_cents, ratio, round2
from storeloom.functions.selection import (approx_quantiles, exact_quantiles,
                                           quantiles_of_counts, value_counts)

ORDER_VALUE_QUANTILES = {"median": 0.5, "q25": 0.25, "q75": 0.75, "q90": 0.9, "q95": 0.95}
MEDIAN = {"median": 0.5}
SECTION = {"total": "order_value_distribution", "quantity": "quantity_distribution",
           "price": "price_distribution"}


def _long(section: str, row: DataFrame) -> DataFrame:
    """A one-row frame of numbers as ``(section, metric, value)``."""
    doubles = row.select(*[F.col(c).cast("double").alias(c) for c in row.columns])
    return (doubles.unpivot([], row.columns, "metric", "value")
            .select(F.lit(section).alias("section"), "metric", "value"))


def _measures(sales: DataFrame, columns: list[str]) -> DataFrame:
    """``(measure, value)`` rows of several columns, so that one pass serves all."""
    return (sales.select(*[F.col(c).cast("double").alias(c) for c in columns])
            .unpivot([], columns, "measure", "value"))


def _quantile_rows(found: DataFrame, wanted: dict[str, dict[str, float]],
                   probabilities: list[float]) -> DataFrame:
    """``(section, metric, value)`` from one quantile array per measure."""
    def named(names: dict[str, float]) -> Column:
        return F.create_map(*[
            x for name, p in names.items()
            for x in (F.lit(name), F.element_at("quantiles", probabilities.index(p) + 1))])

    cases = [F.when(F.col("measure") == c, named(names)) for c, names in wanted.items()]
    section = F.create_map(*[F.lit(x) for c in wanted for x in (c, SECTION[c])])
    return (found.select("measure", F.explode(F.coalesce(*cases)).alias("metric", "raw"))
            .select(section[F.col("measure")].alias("section"), "metric",
                    round2(F.col("raw")).alias("value")))


def _quantiles(sales: DataFrame, wanted: dict[str, dict[str, float]], approx: bool) -> DataFrame:
    """Named quantiles of the given columns.

    All columns use the union of the probabilities; unwanted ones are free.
    """
    probabilities = sorted({p for names in wanted.values() for p in names.values()})
    find = approx_quantiles if approx else exact_quantiles
    found = find(_measures(sales, list(wanted)), "value", probabilities, ["measure"])
    return _quantile_rows(found, wanted, probabilities)


def _moments(column: str, prefix: str = "") -> list[Column]:
    exact_sum = from_cents(F.sum(cents(column)))
    return [ratio(exact_sum, F.count(column)).alias(f"{prefix}mean"),
            round2(F.stddev_samp(F.col(column).cast("double"))).alias(f"{prefix}std"),
            F.min(column).cast("double").alias(f"{prefix}min"),
            F.max(column).cast("double").alias(f"{prefix}max")]


def _span(column: str, prefix: str = "") -> list[Column]:
    """Mean, least and greatest of a whole-number column."""
    return [ratio(F.sum(F.col(column).cast("bigint")), F.count(column)).alias(f"{prefix}mean"),
            F.min(column).alias(f"{prefix}min"), F.max(column).alias(f"{prefix}max")]


def order_value_distribution(sales: DataFrame, approx: bool = False) -> DataFrame:
    section = "order_value_distribution"
    return (_long(section, sales.agg(*_moments("total")))
            .unionByName(_quantiles(sales, {"total": ORDER_VALUE_QUANTILES}, approx)))


def mode_of_counts(counts: DataFrame, where: Column | None = None) -> DataFrame:
    """The most frequent value, the smallest on ties, from counted values.

    ``where`` picks counts inside the aggregation: a filter would move below
    the counting and make Spark count a second time.
    """
    row = F.struct(F.col("rows"), (-F.col("value")).alias("low"))
    best = F.max(row if where is None else F.when(where, row))
    return counts.agg((-best["low"]).alias("mode"))


def quantity_mode(sales: DataFrame) -> DataFrame:
    """Counting per value combines on the map side; the rest is a maximum."""
    return mode_of_counts(value_counts(sales, "quantity"))


def quantity_distribution(sales: DataFrame, approx: bool = False) -> DataFrame:
    section = "quantity_distribution"
    return (_long(section, sales.agg(*_span("quantity")))
            .unionByName(_long(section, quantity_mode(sales)))
            .unionByName(_quantiles(sales, {"quantity": MEDIAN}, approx)))


def price_distribution(sales: DataFrame, approx: bool = False) -> DataFrame:
    section = "price_distribution"
    return (_long(section, sales.agg(*_moments("price")))
            .unionByName(_quantiles(sales, {"price": MEDIAN}, approx)))


def _overall(fact: DataFrame, approx: bool = False) -> DataFrame:
    """One row of grand totals and distinct clients, products and countries.

    The fact is combined by client and country first, so the distinct counts
    of these expand one row per client and not every purchase. Products are
    counted in a scan of their own, which combines on the map side.
    """
    base = fact.groupBy("id_client", "country").agg(
        F.sum(cents("total")).alias("revenue"), F.count("id_purchase").alias("orders"),
        F.sum(F.col("quantity").cast("bigint")).alias("items"))
    distinct = F.approx_count_distinct if approx else F.countDistinct
    revenue, orders = from_cents(F.sum("revenue")), F.sum("orders")
    products = fact.agg(distinct("product").alias("total_products")).scalar()
    return base.agg(
        revenue.alias("total_revenue"), F.coalesce(orders, F.lit(0)).alias("total_orders"),
        distinct("id_client").alias("total_customers"), distinct("country").alias("total_countries"),
        ratio(revenue, orders).alias("avg_order_value"),
        ratio(F.sum("items"), orders).alias("avg_items_per_order")).select(
        "total_revenue", "total_orders", "total_customers", products.alias("total_products"), "total_countries",
        "avg_order_value", "avg_items_per_order")


def overall_metrics(fact: DataFrame, approx: bool = False) -> DataFrame:
    """Grand totals and distinct clients, products and countries."""
    return _long("overall_metrics", _overall(fact, approx))


def statistical_distributions(fact: DataFrame, approx: bool = False) -> DataFrame:
    """All four sections from three passes over the fact.

    One takes the moments and one the grand totals; quantiles and the mode
    share the third, which counts the values of all three columns.
    """
    row = fact.agg(*_moments("total", "order_value_distribution__"),
                   *_span("quantity", "quantity_distribution__"),
                   *_moments("price", "price_distribution__"))
    doubles = row.select(*[F.col(c).cast("double").alias(c) for c in row.columns])
    parts = F.split("key", "__")
    totals = (doubles.unpivot([], doubles.columns, "key", "value")
              .select(parts[0].alias("section"), parts[1].alias("metric"), "value"))

    wanted = {"total": ORDER_VALUE_QUANTILES, "quantity": MEDIAN, "price": MEDIAN}
    if approx:
        quantiles = _quantiles(fact, wanted, approx)
        mode = quantity_mode(fact)
    else:
        probabilities = sorted(set(ORDER_VALUE_QUANTILES.values()))
        counts = value_counts(_measures(fact, list(wanted)), "value", ["measure"])
        found = quantiles_of_counts(counts, probabilities, ["measure"])
        quantiles = _quantile_rows(found, wanted, probabilities)
        mode = mode_of_counts(counts, F.col("measure") == "quantity")
    return (totals.unionByName(overall_metrics(fact, approx)).unionByName(quantiles)
            .unionByName(_long("quantity_distribution", mode)))


def top_performers(products: DataFrame, countries: DataFrame, clients: DataFrame) -> DataFrame:
    """Best product, country and client, one row; ties go to the first name or id."""
    def best(df: DataFrame, value: str, tie: str, shown: str, out: str) -> DataFrame:
        # Greatest value, then least tie column: min over (-value, tie).
        order = F.struct((-F.col(value).cast("double")).alias("v"), F.col(tie).alias("t"))
        return df.agg(F.min_by(F.col(shown), order).alias(out))

    product = best(products, "total_revenue", "product", "product", "p")
    country = best(countries, "total_revenue", "country", "country", "c")
    client = best(clients, "total_spent", "id_client", "name", "n")
    return products.sparkSession.range(1).select(
        product.scalar().alias("top_product_by_revenue"),
        country.scalar().alias("top_country_by_revenue"),
        client.scalar().alias("top_client_by_spending"))


def gold_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """The executive summary as ``(section, metric, value)`` text rows.

    ``tables`` are the gold tables; only small columns of them are read.
    """
    fact, clients = tables["fact_sales"], tables["client_kpis"]
    products, countries = tables["product_analytics"], tables["country_analytics"]

    def text(section: str, row: DataFrame) -> DataFrame:
        strings = row.select(*[F.col(c).cast("string").alias(c) for c in row.columns])
        return (strings.unpivot([], row.columns, "metric", "value")
                .select(F.lit(section).alias("section"), "metric", "value"))

    def rows(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias(name))

    parts = [
        text("fact_table", fact.agg(F.count(F.lit(1)).alias("total_rows"),
                                    F.min("purchase_date").alias("date_min"),
                                    F.max("purchase_date").alias("date_max"))),
        text("kpis", clients.agg(F.count(F.lit(1)).alias("total_clients"),
                                 F.count_if("is_active").alias("active_clients"),
                                 F.count_if("is_high_value").alias("high_value_clients"))),
        text("kpis", rows(products, "total_products")),
        text("kpis", rows(countries, "total_countries")),
        text("temporal_aggregations", rows(tables["daily_sales"], "daily_records")),
        text("temporal_aggregations", rows(tables["weekly_sales"], "weekly_records")),
        text("temporal_aggregations", rows(tables["monthly_sales"], "monthly_records")),
        text("top_performers", top_performers(products, countries, clients)),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
