"""Boundary cases, invariants and golden numbers of the gold layer."""

from datetime import date

import pytest
from storeloom.checks import queries as checks
from pyspark.sql import functions as F
from storeloom.functions import calendar as cal
from storeloom.operators import facts, kpis, serving, stats, temporal
from storeloom.plans import gold
from storeloom.session import through_table
from storeloom.sources import starschema

SALES = ("id_purchase bigint, id_client bigint, product string, price decimal(18,2), quantity int, "
         "purchase_date date, total decimal(18,2)")
CLIENTS = "id_client bigint, name string, email string, country string, subscription_date date"


def sales(spark, rows):
    """``(client, product, price, quantity, day)`` rows as purchases."""
    from decimal import Decimal
    return spark.createDataFrame(
        [(i, c, p, Decimal(str(price)), n, d, Decimal(str(price)) * n)
         for i, (c, p, price, n, d) in enumerate(rows)], SALES)


def people(spark, rows):
    return spark.createDataFrame(
        [(i, n, f"{n}@x.com", c, date(2020, 1, 1)) for i, n, c in rows], CLIENTS)


@pytest.mark.parametrize("day,label,span", [
    (date(2024, 12, 29), "2024-W52", "2024-12-23/2024-12-29"),
    (date(2024, 12, 30), "2025-W01", "2024-12-30/2025-01-05"),
    (date(2021, 1, 1), "2020-W53", "2020-12-28/2021-01-03")])
def test_week_labels(spark, day, label, span):
    row = spark.range(1).select(cal.year_week(F.lit(day)), cal.year_week(F.lit(day), "range")).first()
    assert row[:] == (label, span)
    with pytest.raises(ValueError):
        cal.year_week(F.lit(day), "other")


def test_calendar(spark, rows):
    df = spark.createDataFrame([(date(2024, 12, 30),)], "purchase_date date")
    assert rows(facts.calendar_attributes(df)) == [
        (date(2024, 12, 30), 2024, 12, 4, 1, 0, "Monday")]


def test_growth(spark):
    df = spark.createDataFrame([(1, 100.0), (2, 0.0), (3, 50.0), (4, 50.0), (5, 25.0)],
                               "t int, v double")
    got = temporal.growth(df, "t", {"v": "g"}).orderBy("t").collect()
    assert [r.g for r in got] == [None, -100.0, None, 0.0, -50.0]


def test_rolling_mean_counts_days_with_sales(spark):
    days = [date(2024, 1, d) for d in (1, 2, 3, 5, 6, 7, 8, 20)]
    df = sales(spark, [(1, "p", 10 * (i + 1), 1, d) for i, d in enumerate(days)])
    got = temporal.daily_sales(df).collect()
    assert [r.revenue_7day_avg for r in got] == [10.0, 15.0, 20.0, 25.0, 30.0, 35.0, 40.0, 50.0]
    assert got[0].orders_7day_avg == 1.0


def test_top_countries_with_ties_and_few(spark, rows):
    c = people(spark, [(1, "a", "FR"), (2, "b", "DE"), (3, "c", "ES"), (4, "d", "IT")])
    d = date(2024, 1, 1)
    p = sales(spark, [(1, "x", 5, 1, d), (2, "x", 5, 1, d), (3, "x", 9, 1, d), (4, "x", 1, 1, d),
                      (1, "y", 1, 1, d), (2, "y", 2, 1, d)])
    assert rows(kpis.product_top_countries(facts.fact_join(p, c))) == [
        ("x", "ES, DE, FR"), ("y", "DE, FR")]


def test_client_flags(spark):
    c = people(spark, [(i, f"n{i}", "FR") for i in range(4)])
    days = [date(2024, 3, 3), date(2024, 3, 2), date(2024, 6, 1), date(2023, 1, 1)]
    p = sales(spark, [(i, "p", v, 1, d) for i, (v, d) in enumerate(zip([1, 2, 3, 10], days))])
    got = {r.id_client: r for r in kpis.client_kpis(p, c, date(2024, 6, 1)).collect()}
    assert [got[i].is_active for i in range(4)] == [True, False, True, False]   # 90, 91, 0 days
    assert [got[i].is_high_value for i in range(4)] == [False, False, True, True]   # median 2.5
    assert got[2].purchase_frequency_per_month == 1.0    # lifetime below a month counts as one


def test_orphans_keep_their_own_country_group(spark):
    c = people(spark, [(1, "a", "FR")])
    p = sales(spark, [(1, "x", 5, 1, date(2024, 1, 1)), (9, "x", 15, 1, date(2024, 1, 1))])
    got = {r.country: r for r in kpis.country_analytics(kpis.client_totals(p, c)).collect()}
    assert got[None].total_revenue == 15.0 and got["FR"].market_share_pct == 25.0


def test_mode_and_quantiles(spark):
    p = sales(spark, [(1, "x", 1, q, date(2024, 1, 1)) for q in (1, 2, 2, 1)])
    assert stats.quantity_mode(p).first().mode == 1
    p = sales(spark, [(1, "x", v, 1, date(2024, 1, 1)) for v in (1, 2, 3, 10)])
    got = {r.metric: r.value for r in stats.order_value_distribution(p).collect()}
    assert got["median"] == 2.5 and got["q25"] == 1.75
    near = {r.metric: r.value for r in stats.order_value_distribution(p, approx=True).collect()}
    assert near["median"] in (2.0, 3.0) and set(near) == set(got)


def test_exact_sums_of_many_cents(spark):
    p = spark.range(100_000).selectExpr(
        "id id_purchase", "1 id_client", "'x' product", "cast(0.1 as decimal(18,2)) price",
        "1 quantity", "date'2024-01-01' purchase_date", "cast(0.1 as decimal(18,2)) total")
    assert temporal.daily_totals(p).first().total_revenue == 10000.0


@pytest.fixture(scope="module")
def tables(spark, golden):
    clients = through_table(starschema.clients(spark, golden), "clients")
    purchases = through_table(starschema.purchases(spark, golden), "purchases")
    return {k: through_table(v, k) for k, v in gold.build(clients, purchases, checks.AS_OF).items()}


def test_golden_gold(tables):
    summary = {r.metric: r.value for r in stats.gold_summary(tables).collect()}
    assert summary == {
        "total_rows": "60000", "date_min": "1995-01-01", "date_max": "2001-08-01",
        "total_clients": "1500", "active_clients": "468", "high_value_clients": "750",
        "total_products": "6", "total_countries": "25", "daily_records": "2399",
        "weekly_records": "345", "monthly_records": "80", "top_product_by_revenue": "MEDIUM",
        "top_country_by_revenue": "NATION_7", "top_client_by_spending": "Customer#000000605"}
    assert tables["fact_sales"].where("customer_tenure_days < 0").count() == 0


def test_totals_agree_on_every_grain(tables):
    revenue = 1447849638.0
    for name in ("daily_sales", "weekly_sales", "monthly_sales", "country_analytics",
                 "product_analytics"):
        got = tables[name].agg(F.sum(F.col("total_revenue").cast("decimal(18,2)"))).first()[0]
        assert float(got) == revenue, name
    share = tables["country_analytics"].agg(F.sum("market_share_pct")).first()[0]
    assert share == pytest.approx(100, abs=0.005 * 25)
    kpi = serving.global_kpis(tables["daily_sales"], tables["client_kpis"]).first()
    assert kpi.total_revenue == revenue and kpi.total_customers == 1500


def test_serving_lists(tables):
    assert [r.total_revenue for r in serving.top_products(tables["product_analytics"], 2).collect()] \
        == [252282312.0, pytest.approx(249084871.8)]
    assert serving.countries_by_revenue(tables["country_analytics"], 10).count() == 10
    last = serving.recent_days(tables["daily_sales"], 30).collect()
    assert len(last) == 30 and last[-1].date == date(2001, 8, 1)
    assert serving.top_clients(tables["client_kpis"], 3, full_rows=True).columns \
        == tables["client_kpis"].columns
    with pytest.raises(ValueError):
        serving.temporal_sales(tables, "yearly")


def test_nan_to_null(spark):
    inf = float("inf")
    df = spark.createDataFrame([(float("nan"),), (inf,), (-inf,), (None,), (1.0,)], "v double")
    assert [r.v for r in serving.nan_to_null(df).collect()] == [None, None, None, None, 1.0]


def test_grand_totals_shuffle_no_products(spark, sf):
    """Totals and distinct counts keep nulls apart, and no row goes out for each client, product and country."""
    rows = [(1, 10, "a", "x", 2, 1.50), (2, 10, "b", "x", 1, 2.25), (3, 11, "a", "y", 1, 4.00),
            (4, None, None, None, 3, 0.25), (5, 11, "a", "y", 2, 1.00)]
    fact = spark.createDataFrame(rows, "id_purchase bigint, id_client bigint, product string, country string, "
                                       "quantity int, t double").withColumn("total", F.col("t").cast("decimal(18,2)"))
    out = stats.overall_metrics(fact)
    assert {r.metric: r.value for r in out.collect()} == {
        "total_revenue": 9.0, "total_orders": 5, "total_customers": 2, "total_products": 2, "total_countries": 2,
        "avg_order_value": 1.8, "avg_items_per_order": 1.8}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    grouped = [line for line in plan.splitlines() if "Aggregate [" in line and "id_client#" in line.split("],")[0]]
    assert grouped and not any("product#" in line.split("],")[0] for line in grouped)
