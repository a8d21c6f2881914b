"""One query per operator over the given tables.

Results leave through :func:`edge`: dates as text, money as double and whole
numbers as ``bigint``, the forms the SQL statements use as well.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from storeloom.functions.numeric import round2
from storeloom.layout import Layout
from storeloom.operators import analyses, facts, kpis, ml, quality, serving, silver, stats, temporal
from storeloom.plans import gold, incremental, prediction, refresh
from storeloom.plans.pipeline import run_pipeline, summary_of
from storeloom.schemas import BRONZE, CLIENT_COLUMNS, GOLD_TABLES, PURCHASE_COLUMNS
from storeloom.session import scratch_path, through_table
from storeloom.sources import files, sinks, starschema
from storeloom.sources.published import Store

AS_OF = date(2001, 8, 2)
Query = Callable[[SparkSession, str], DataFrame]


def edge(df: DataFrame) -> DataFrame:
    changes = {}
    for name, kind in df.dtypes:
        if kind.startswith("decimal"):
            changes[name] = F.col(name).cast("double")
        elif kind in ("int", "smallint", "tinyint"):
            changes[name] = F.col(name).cast("bigint")
    out = df.withColumns(changes) if changes else df
    return quality.format_dates(out)


# --- inputs ----------------------------------------------------------------

def _clean(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return starschema.clients(spark, sf), starschema.purchases(spark, sf)


def _dirty(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return starschema.dirty_clients(spark, sf), starschema.dirty_purchases(spark, sf)


def _with_client_ids(spark: SparkSession, sf: str) -> DataFrame:
    return starschema.dirty_purchases(spark, sf).withColumn("id_client", quality.number("id_client"))


def _valid(spark: SparkSession, sf: str) -> DataFrame:
    return silver.clean_clients(starschema.dirty_clients(spark, sf), AS_OF)


def _tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    # Eight tables read the purchases, so their joins run once.
    clients, purchases = _clean(spark, sf)
    return gold.build(clients, through_table(purchases, "purchases"), AS_OF)


def _fact(spark: SparkSession, sf: str) -> DataFrame:
    clients, purchases = _clean(spark, sf)
    return facts.fact_sales(purchases, clients)


def _totals(spark: SparkSession, sf: str) -> DataFrame:
    clients, purchases = _clean(spark, sf)
    return kpis.client_totals(purchases, clients)


def _kpis(spark: SparkSession, sf: str) -> DataFrame:
    clients, purchases = _clean(spark, sf)
    return kpis.client_kpis(purchases, clients, AS_OF)


def _source_csv(spark: SparkSession, clients: DataFrame, purchases: DataFrame) -> str:
    """The two tables as a folder of CSV files, the form sources arrive in."""
    folder = scratch_path(spark, "sources")
    sinks.write_csv(clients, f"{folder}/clients.csv")
    sinks.write_csv(purchases, f"{folder}/purchases.csv")
    return folder


# One gold run and one pair of models serve all queries of a session.
@lru_cache(maxsize=4)
def _gold_run(spark: SparkSession, sf: str) -> tuple[Layout, DataFrame]:
    layout = Layout(scratch_path(spark, "lake"))
    clients, purchases = _clean(spark, sf)
    sinks.write_parquet(clients, layout.path("silver", "clients"))
    sinks.write_parquet(purchases, layout.path("silver", "purchases"))
    return layout, gold.gold_flow(spark, layout, AS_OF)


@lru_cache(maxsize=4)
def _feature_table(spark: SparkSession, sf: str) -> DataFrame:
    return through_table(_features(spark, sf), "features")


@lru_cache(maxsize=4)
def _models(spark: SparkSession, sf: str) -> tuple[ml.Fitted, ml.Fitted]:
    features = _feature_table(spark, sf)
    return ml.train_churn_model(features), ml.train_clv_model(features)


@lru_cache(maxsize=4)
def _predictions(spark: SparkSession, sf: str) -> DataFrame:
    return ml.predict_clients(_feature_table(spark, sf), *_models(spark, sf))


# Limits of the three batches: each overlaps the one before.
BATCH_LIMITS = ["1997-06-01", "1999-09-01"]


def _batches(spark: SparkSession, sf: str) -> list[DataFrame]:
    """The purchases as three overlapping batches with late, wrong, corrected and deleted rows."""
    rows = quality.dedup_by_key(starschema.purchases(spark, sf), "id_purchase", silver.PURCHASE_ORDER)
    rows = through_table(rows, "unique").withColumn("deleted", F.lit(False))
    key, day = F.col("id_purchase"), F.col("purchase_date")
    early, middle = (F.lit(d).cast("date") for d in BATCH_LIMITS)
    late, miscounted, misplaced, taken_back = key % 19 == 3, key % 13 == 5, key % 17 == 6, key % 101 == 7
    quantity = F.when(miscounted, F.col("quantity") + 1).otherwise(F.col("quantity"))
    price = F.when(misplaced, F.col("price") * 10).otherwise(F.col("price")).cast("decimal(18,2)")
    first = rows.filter((day < early) & ~late).withColumns({
        "quantity": quantity, "price": price, "total": (price * quantity).cast("decimal(18,2)"),
        "id_client": F.when(misplaced, F.col("id_client") + 1).otherwise(F.col("id_client")),
        "purchase_date": F.when(misplaced, F.date_sub(day, 400)).otherwise(day)})
    second = rows.filter(((day >= F.date_sub(early, 30)) & (day < middle)) | ((day < early) & (late | miscounted)))
    third = rows.filter(((day >= middle) | ((day < early) & misplaced)) & ~taken_back)
    return [first, second, third.unionByName(rows.filter(taken_back).withColumn("deleted", F.lit(True)))]


@lru_cache(maxsize=4)
def _batched(spark: SparkSession, sf: str) -> Store:
    """A store that has taken the three batches, the second one twice."""
    store = Store(spark, scratch_path(spark, "incremental"))
    for n, batch in enumerate(_batches(spark, sf), start=1):
        incremental.apply_batch(store, f"batch-{n}", batch)
        if n == 2:
            incremental.apply_batch(store, "batch-2", batch)
    return store


# --- files and layers ------------------------------------------------------

def scan_csv(spark, sf):
    path = scratch_path(spark, "purchases-csv")
    sinks.write_csv(starschema.dirty_purchases(spark, sf), path)
    return files.scan_csv(spark, path, BRONZE["purchases"])


def scan_parquet(spark, sf):
    path = scratch_path(spark, "clients-parquet")
    sinks.write_parquet(starschema.clients(spark, sf), path)
    return files.scan_parquet(spark, path)


def scan_json_report(spark, sf):
    layout, _ = _gold_run(spark, sf)
    path = layout.export("gold", "statistical_distributions", "json")
    return silver.report_rows(files.scan_json_report(spark, path), gold.STATISTICS_SECTIONS)


def bronze_ingest(spark, sf):
    layout = Layout(scratch_path(spark, "bronze"))
    landed = files.bronze_ingest(spark, _source_csv(spark, *_dirty(spark, sf)), layout)

    def record(table: str, key: str, columns: list[str]) -> DataFrame:
        parts = [F.coalesce(F.col(c), F.lit("<null>")) for c in columns]
        return landed[table].select(F.lit(table).alias("table_name"), F.col(key).alias("key"),
                                    F.concat_ws("|", *parts).alias("record"))

    return (record("clients", "id_client", CLIENT_COLUMNS)
            .unionByName(record("purchases", "id_purchase", PURCHASE_COLUMNS)))


def ingest_if_absent(spark, sf):
    layout = Layout(scratch_path(spark, "bronze"))
    files.bronze_ingest(spark, _source_csv(spark, *_dirty(spark, sf)), layout)
    # Landing the clean tables afterwards must change nothing.
    landed = files.bronze_ingest(spark, _source_csv(spark, *_clean(spark, sf)), layout,
                                 if_absent=True)
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("table_name"), "rows")
        for t, df in landed.items()])


def write_csv(spark, sf):
    path = scratch_path(spark, "clients-csv")
    sinks.write_csv(starschema.clients(spark, sf), path)
    return (files.scan_csv(spark, path, BRONZE["clients"])
            .withColumn("id_client", F.col("id_client").cast("bigint")))


def write_parquet(spark, sf):
    path = scratch_path(spark, "fact")
    sinks.write_parquet(_fact(spark, sf), path, partition_by=["purchase_year"])
    return spark.read.parquet(path)


def write_json_report(spark, sf):
    path = scratch_path(spark, "quality-report")
    sinks.write_json_report(_quality(spark, sf), path, stamp="report_timestamp")
    return silver.report_rows(files.scan_json_report(spark, path))


def refresh_serving(spark, sf):
    layout, _ = _gold_run(spark, sf)
    # A table that is not there must show as failed.
    done = refresh.refresh_serving(spark, layout, [*GOLD_TABLES, "no_such_table"])
    return done.select("table", "status", "rows")


def nan_to_null(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    kind = F.col("event_id") % 4
    faulty = (F.when(kind == 0, float("nan")).when(kind == 1, float("inf"))
              .when(kind == 2, float("-inf")).otherwise(F.col("value")))
    return serving.nan_to_null(events.select("event_id", faulty.alias("value")))


def run_whole_pipeline(spark, sf):
    layout = Layout(scratch_path(spark, "lake"))
    source = _source_csv(spark, *_dirty(spark, sf))
    return summary_of(run_pipeline(spark, source, layout, AS_OF))


# --- silver ----------------------------------------------------------------

def profile_nulls(spark, sf):
    clients, purchases = _dirty(spark, sf)

    def of(df, name):
        return quality.profile_nulls(df).select(F.lit(name).alias("table_name"), "column",
                                                "null_count")

    return of(clients, "clients").unionByName(of(purchases, "purchases"))


def _dated(spark, sf):
    return (starschema.dirty_purchases(spark, sf).select("id_purchase", "purchase_date")
            .transform(lambda d: quality.parse_dates(d, "purchase_date")))


def cap_future_dates(spark, sf):
    return quality.cap_future_dates(_dated(spark, sf), "purchase_date", AS_OF)


def format_dates(spark, sf):
    return quality.format_dates(
        starschema.clients(spark, sf).select("id_client", "subscription_date"))


def dedup_by_key(spark, sf):
    typed = (starschema.dirty_purchases(spark, sf)
             .transform(quality.drop_null_rows)
             .transform(lambda d: quality.parse_dates(d, "purchase_date"))
             .transform(quality.coerce_numeric)
             .transform(quality.reject_negative)
             .transform(quality.recalc_total)
             .select(*PURCHASE_COLUMNS))
    return quality.dedup_by_key(typed, "id_purchase", silver.PURCHASE_ORDER)


def dedup_by_email(spark, sf):
    typed = (starschema.dirty_clients(spark, sf)
             .transform(quality.drop_null_rows)
             .transform(lambda d: quality.parse_dates(d, "subscription_date"))
             .transform(lambda d: quality.cap_future_dates(d, "subscription_date", AS_OF))
             .transform(quality.validate_email)
             .transform(quality.coerce_numeric))
    by_id = quality.dedup_by_key(typed, "id_client", silver.CLIENT_ORDER)
    return quality.dedup_by_email(by_id)


def normalize_strings(spark, sf):
    return quality.normalize_strings(starschema.dirty_clients(spark, sf),
                                     trim=["name", "country"], lower=["email"])


def coerce_numeric(spark, sf):
    return quality.coerce_numeric(starschema.dirty_purchases(spark, sf))


def recalc_total(spark, sf):
    return quality.recalc_total(coerce_numeric(spark, sf)).select(
        "id_purchase", "price", "quantity", "total", "total_recalculated")


def _bronze_purchases(spark, sf):
    """The faulty purchases as the Parquet table that cleaning reads, so no check is pulled into the fixture's joins."""
    return through_table(starschema.dirty_purchases(spark, sf), "bronze-purchases")


def clean_purchases(spark, sf):
    return silver.clean_purchases(_bronze_purchases(spark, sf), _valid(spark, sf), AS_OF)


def quality_clients(spark, sf):
    return silver.quality_clients(starschema.dirty_clients(spark, sf), AS_OF)


def quality_purchases(spark, sf):
    return silver.quality_purchases(_bronze_purchases(spark, sf), _valid(spark, sf), AS_OF)


def _quality(spark, sf):
    clients, purchases = starschema.dirty_clients(spark, sf), _bronze_purchases(spark, sf)
    return silver.quality_report(
        silver.client_quality_row(clients, AS_OF),
        silver.purchase_quality_row(purchases, _valid(spark, sf), AS_OF))


def quality_report(spark, sf):
    return silver.report_rows(_quality(spark, sf))


# --- gold ------------------------------------------------------------------

def fact_join(spark, sf):
    clients, purchases = _clean(spark, sf)
    return facts.fact_join(purchases, clients)


def client_activity_flag(spark, sf):
    recent = kpis.client_recency_frequency(_totals(spark, sf), AS_OF)
    return kpis.client_activity_flag(recent).select("id_client", "days_since_last_purchase",
                                                    "is_active")


def client_high_value_flag(spark, sf):
    return kpis.client_high_value_flag(_totals(spark, sf)).select("id_client", "total_spent",
                                                                  "is_high_value")


def product_top_countries_join(spark, sf):
    fact = fact_join(spark, sf)
    return kpis.product_top_countries_join(
        kpis.product_totals(fact), kpis.product_top_countries(fact)).select(
        "product", "total_revenue", "top_countries")


def market_share(spark, sf):
    return kpis.market_share(kpis.country_totals(_totals(spark, sf))).select(
        "country", "total_revenue", "market_share_pct")


def top_k_per_group(spark, sf):
    spend = _totals(spark, sf).select("country", "id_client", "total_spent")
    return kpis.top_k_per_group(spend, ["country"],
                                [F.col("total_spent").desc(), F.col("id_client")], 3)


def _series(total):
    return lambda spark, sf: total(starschema.purchases(spark, sf))


def rolling_7day(spark, sf):
    daily = temporal.daily_totals(starschema.purchases(spark, sf))
    return temporal.rolling_7day(daily).select("date", "revenue_7day_avg", "orders_7day_avg")


def daily_growth(spark, sf):
    daily = temporal.daily_totals(starschema.purchases(spark, sf))
    return temporal.daily_growth(daily).select("date", "revenue_growth_pct")


def weekly_growth(spark, sf):
    weekly = temporal.weekly_totals(starschema.purchases(spark, sf))
    return temporal.weekly_growth(weekly).select("year_week", "revenue_growth_pct")


def monthly_growth(spark, sf):
    monthly = temporal.monthly_totals(starschema.purchases(spark, sf))
    return temporal.monthly_growth(monthly).select(
        "year_month", "revenue_growth_pct", "orders_growth_pct", "customers_growth_pct")


# --- incremental gold ------------------------------------------------------

def incremental_gold(spark, sf):
    store = _batched(spark, sf)
    none = F.lit(None)

    def part(df: DataFrame, table: str, key, **columns) -> DataFrame:
        return df.select(F.lit(table).alias("table_name"), key.alias("key"), *[
            columns.get(c, none).cast(kind).alias(c) for c, kind in {
                "orders": "bigint", "quantity": "bigint", "revenue": "double", "customers": "bigint",
                "low": "double", "high": "double", "first_day": "date", "last_day": "date"}.items()])

    c = F.col
    clients = part(incremental.client_totals(store), "clients", c("id_client").cast("string"),
                   orders=c("total_purchases"), quantity=c("total_quantity"), revenue=c("total_spent"),
                   low=c("min_order_value"), high=c("max_order_value"), first_day=c("first_purchase_date"),
                   last_day=c("last_purchase_date"))
    days = part(incremental.daily_totals(store), "days", c("date").cast("string"), orders=c("total_orders"),
                quantity=c("total_quantity"), revenue=c("total_revenue"), customers=c("unique_customers"))
    products = part(incremental.product_country_totals(store, starschema.clients(spark, sf)), "products",
                    F.concat_ws("|", "product", "country"), orders=c("total_orders"), quantity=c("total_quantity"),
                    revenue=c("total_revenue"), customers=c("unique_customers"), low=c("min_price"),
                    high=c("max_price"))
    return clients.unionByName(days).unionByName(products)


def incremental_batches(spark, sf):
    store = _batched(spark, sf)
    return incremental.batch_reports(store).withColumn("versions", F.lit(store.version()))


def monthly_partitions(spark, sf):
    return incremental.read_purchases(_batched(spark, sf), "1997-03", "1997-08")


# --- serving ---------------------------------------------------------------

def global_kpis(spark, sf):
    return serving.global_kpis(temporal.daily_sales(starschema.purchases(spark, sf)),
                               _totals(spark, sf))


def temporal_sales(spark, sf):
    purchases = starschema.purchases(spark, sf)
    tables = {"daily_sales": temporal.daily_sales(purchases),
              "weekly_sales": temporal.weekly_sales(purchases),
              "monthly_sales": temporal.monthly_sales(purchases)}
    label = {"daily": F.date_format("date", "yyyy-MM-dd"), "weekly": F.col("year_week"),
             "monthly": F.col("year_month")}
    return reduce(DataFrame.unionByName, [
        serving.temporal_sales(tables, period).select(
            F.lit(period).alias("period"), key.alias("key"), "total_revenue", "total_orders",
            "unique_customers", "total_quantity", "revenue_growth_pct")
        for period, key in label.items()])


def top_performers(spark, sf):
    totals = _totals(spark, sf)
    return stats.top_performers(kpis.product_totals(starschema.purchases(spark, sf)),
                                kpis.country_totals(totals), totals)


def serving_lookup(spark, sf):
    layout, _ = _gold_run(spark, sf)
    refresh.load_table(spark, layout, "fact_sales")
    return serving.serving_lookup(refresh.read_serving(spark, layout, "fact_sales"), id_client=55)


# --- prediction ------------------------------------------------------------

def _feature_inputs(spark, sf):
    """All clients with the cleaned purchases.

    Cleaning drops the purchases of the clients it rejects, so some of all
    clients have none.
    """
    return starschema.clients(spark, sf), clean_purchases(spark, sf)


def _features(spark, sf):
    return ml.client_features(*_feature_inputs(spark, sf), AS_OF)


def features_join(spark, sf):
    return ml.features_join(*_feature_inputs(spark, sf)).select(
        "id_client", "name", "country", F.col("total_purchases").isNull().alias("never_bought"),
        F.coalesce("total_quantity", F.lit(0).cast("bigint")).alias("total_quantity"),
        "min_order_value", "max_order_value")


def client_features(spark, sf):
    return _features(spark, sf).withColumns({
        c: round2(F.col(c)) for c in ("avg_order_value", "purchase_frequency_per_month")})


def churn_label(spark, sf):
    return _features(spark, sf).select("id_client", "days_since_last_purchase", "is_churned")


def _synthetic_scores(spark, sf):
    """Scores that hit every band limit, independent of any model."""
    return _totals(spark, sf).select(
        "id_client", ((F.col("id_client") % 101).cast("double") / 100).alias("churn_probability"),
        F.col("total_spent").cast("double").alias("predicted_clv"))


def churn_risk_band(spark, sf):
    return _synthetic_scores(spark, sf).select(
        "id_client", "churn_probability",
        ml.churn_risk_band(F.col("churn_probability")).alias("churn_risk"))


def client_segments(spark, sf):
    return ml.client_segments(_synthetic_scores(spark, sf))


def segment_insights(spark, sf):
    return ml.segment_insights(client_segments(spark, sf))


def stratified_split(spark, sf):
    return ml.stratified_split(_feature_table(spark, sf)).select("id_client", "is_churned", "is_train")


def churn_model(spark, sf):
    churn, _ = _models(spark, sf)
    return churn.held_out.select("id_client", "label", "churn_prediction",
                                 F.element_at(ml.vector_to_array("churn_vector"), 2)
                                 .alias("churn_probability"))


def clv_model(spark, sf):
    _, clv = _models(spark, sf)
    return clv.held_out.select("id_client", "label", "clv_prediction")


def feature_importance(spark, sf):
    churn, clv = _models(spark, sf)
    return reduce(DataFrame.unionByName, [
        ml.feature_importance(spark, m).select(F.lit(name).alias("model"), "feature", "importance")
        for name, m in (("churn", churn), ("clv", clv))])


def save_model(spark, sf):
    layout = Layout(scratch_path(spark, "models"))
    report = prediction.save_model(spark, layout, *_models(spark, sf), _predictions(spark, sf))
    # Score again with the models as loaded from disk.
    churn, clv = prediction.load_models(layout)
    features = _feature_table(spark, sf)
    again = ml.score_clients(features, ml.Fitted(churn, ml.CHURN_FEATURES, features),
                             ml.Fitted(clv, ml.CLV_FEATURES, features))
    return again.select("id_client", "churn_probability", "predicted_clv",
                        report.select("churn_model.accuracy").scalar().alias("reported_accuracy"))


# --- registry --------------------------------------------------------------

def _products(spark: SparkSession, sf: str) -> DataFrame:
    return kpis.product_analytics(fact_join(spark, sf))


def _countries(spark: SparkSession, sf: str) -> DataFrame:
    return kpis.country_analytics(_totals(spark, sf))


def _of_kpis(operator) -> Query:
    return lambda spark, sf: operator(_kpis(spark, sf))


_QUERIES: dict[str, Query] = {
    "scan_csv": scan_csv,
    "scan_parquet": scan_parquet,
    "scan_json_report": scan_json_report,
    "bronze_ingest": bronze_ingest,
    "ingest_if_absent": ingest_if_absent,
    "write_csv": write_csv,
    "write_parquet": write_parquet,
    "write_json_report": write_json_report,
    "refresh_serving": refresh_serving,
    "nan_to_null": nan_to_null,
    "run_pipeline": run_whole_pipeline,

    "profile_nulls": profile_nulls,
    "drop_null_rows": lambda s, d: quality.drop_null_rows(starschema.dirty_purchases(s, d)),
    "parse_dates": _dated,
    "cap_future_dates": cap_future_dates,
    "format_dates": format_dates,
    "validate_email": lambda s, d: quality.validate_email(starschema.dirty_clients(s, d)),
    "dedup_by_key": dedup_by_key,
    "dedup_by_email": dedup_by_email,
    "normalize_strings": normalize_strings,
    "coerce_numeric": coerce_numeric,
    "reject_negative": lambda s, d: quality.reject_negative(coerce_numeric(s, d)),
    "recalc_total": recalc_total,
    "orphan_semi_join": lambda s, d: quality.orphan_semi_join(
        _with_client_ids(s, d), _valid(s, d)).select(*PURCHASE_COLUMNS),
    "orphan_rejects": lambda s, d: quality.orphan_rejects(
        _with_client_ids(s, d), _valid(s, d)).select(*PURCHASE_COLUMNS),
    "clean_clients": _valid,
    "clean_purchases": clean_purchases,
    "quality_clients": quality_clients,
    "quality_purchases": quality_purchases,
    "quality_report": quality_report,

    "fact_join": fact_join,
    "calendar_attributes": lambda s, d: facts.calendar_attributes(starschema.purchases(s, d)),
    "period_keys": lambda s, d: facts.period_keys(starschema.purchases(s, d)),
    "customer_tenure": lambda s, d: facts.customer_tenure(fact_join(s, d)),
    "fact_sales": _fact,

    "client_totals": _totals,
    "client_recency_frequency": lambda s, d: kpis.client_recency_frequency(_totals(s, d), AS_OF),
    "client_activity_flag": client_activity_flag,
    "client_high_value_flag": client_high_value_flag,
    "client_kpis": _kpis,
    "product_totals": _series(kpis.product_totals),
    "product_top_countries": lambda s, d: kpis.product_top_countries(fact_join(s, d)),
    "product_top_countries_join": product_top_countries_join,
    "product_analytics": _products,
    "country_totals": lambda s, d: kpis.country_totals(_totals(s, d)),
    "market_share": market_share,
    "country_analytics": _countries,
    "daily_totals": _series(temporal.daily_totals),
    "weekly_totals": _series(temporal.weekly_totals),
    "monthly_totals": _series(temporal.monthly_totals),
    "order_value_distribution": _series(stats.order_value_distribution),
    "quantity_distribution": _series(stats.quantity_distribution),
    "price_distribution": _series(stats.price_distribution),
    "overall_metrics": lambda s, d: stats.overall_metrics(fact_join(s, d)),
    "statistical_distributions": lambda s, d: stats.statistical_distributions(fact_join(s, d)),
    "gold_summary": lambda s, d: stats.gold_summary(_tables(s, d)),
    "gold_flow": lambda s, d: _gold_run(s, d)[1],

    "cross_sell": _series(lambda sales: analyses.cross_sell(sales, min_support=0.02)),
    "client_spells": _series(lambda sales: analyses.spells(sales, AS_OF)),
    "retention_curve": _series(lambda sales: analyses.retention_curve(sales, AS_OF)),
    "cohort_matrix": _series(lambda sales: analyses.cohort_matrix(sales, AS_OF)),
    "rfm_scores": lambda s, d: analyses.rfm_scores(kpis.client_recency_frequency(_totals(s, d), AS_OF)),
    "box_plots": _series(analyses.box_plots),
    "sales_anomalies": lambda s, d: analyses.sales_anomalies(*reversed(_clean(s, d))),
    "revenue_forecast": lambda s, d: analyses.revenue_forecast(*reversed(_clean(s, d)), AS_OF),

    "incremental_gold": incremental_gold,
    "incremental_batches": incremental_batches,
    "monthly_partitions": monthly_partitions,

    "rolling_7day": rolling_7day,
    "daily_growth": daily_growth,
    "weekly_growth": weekly_growth,
    "monthly_growth": monthly_growth,
    "top_k_per_group": top_k_per_group,
    "daily_sales": _series(temporal.daily_sales),
    "weekly_sales": _series(temporal.weekly_sales),
    "monthly_sales": _series(temporal.monthly_sales),

    "top_products": lambda s, d: serving.top_products(_products(s, d)),
    "countries_by_revenue": lambda s, d: serving.countries_by_revenue(_countries(s, d)),
    "top_clients": lambda s, d: serving.top_clients(_totals(s, d)),
    "recent_days": lambda s, d: serving.recent_days(
        temporal.daily_sales(starschema.purchases(s, d))),
    "top_performers": top_performers,

    "global_kpis": global_kpis,
    "temporal_sales": temporal_sales,
    "client_distribution": _of_kpis(serving.client_distribution),
    "client_overview": _of_kpis(serving.client_overview),
    "serving_lookup": serving_lookup,

    "features_join": features_join,
    "client_features": client_features,
    "churn_label": churn_label,
    "churn_risk_band": churn_risk_band,
    "client_segments": client_segments,
    "segment_insights": segment_insights,
    "stratified_split": stratified_split,
    "scale_features": lambda s, d: ml.scale_features(ml.stratified_split(_feature_table(s, d))),
    "churn_model": churn_model,
    "churn_metrics": lambda s, d: ml.churn_metrics(_models(s, d)[0]),
    "clv_model": clv_model,
    "clv_metrics": lambda s, d: ml.clv_metrics(_models(s, d)[1]),
    "feature_importance": feature_importance,
    "predict_clients": _predictions,
    "top_at_risk": lambda s, d: ml.top_at_risk(_predictions(s, d)),
    "save_model": save_model,
}


def queries() -> dict[str, Query]:
    def at_edge(query: Query) -> Query:
        return lambda spark, sf_dir: edge(query(spark, sf_dir))

    return {name: at_edge(query) for name, query in _QUERIES.items()}
