"""Boundary cases of the silver steps and the golden waterfall."""

from datetime import date
from decimal import Decimal

import pytest
from storeloom.checks import queries as checks
from pyspark.sql import functions as F
from storeloom.functions.numeric import cents
from storeloom.operators import quality as q
from storeloom.operators import silver
from storeloom.schemas import CLIENT_COLUMNS, PURCHASE_COLUMNS
from storeloom.sources import starschema

TODAY = date(2024, 6, 1)


def purchases(spark, *rows):
    text = ", ".join(f"{c} string" for c in PURCHASE_COLUMNS)
    return spark.createDataFrame([tuple(r) for r in rows], text)


def clients(spark, *rows):
    text = ", ".join(f"{c} string" for c in CLIENT_COLUMNS)
    return spark.createDataFrame([tuple(r) for r in rows], text)


def test_parse_dates_drops_what_is_no_date(spark, rows):
    df = spark.createDataFrame([("2024-01-02",), ("notadate",), ("",), (None,)], "d string")
    assert rows(q.parse_dates(df, "d")) == [(date(2024, 1, 2),)]


def test_future_dates_are_capped(spark, rows):
    df = spark.createDataFrame([(date(2024, 6, 1),), (date(2024, 6, 2),)], "d date")
    assert rows(q.cap_future_dates(df, "d", TODAY)) == [(TODAY,), (TODAY,)]


@pytest.mark.parametrize("address,ok", [
    ("a@b.com", True), (" a@b.com", False), ("a@b.com\n", True), ("a@b.com\n\n", False),
    ("a@b", False), ("a@b.c", False), (None, False), ("A.b+c%d@x-y.co.uk", True)])
def test_email(spark, address, ok):
    df = spark.createDataFrame([(address,)], "email string")
    assert q.validate_email(df).count() == int(ok)


def test_numbers(spark, rows):
    df = purchases(spark, ("1", "1", "p", "12.5", "2", "d", "25"),
                   ("2", "1", "p", "abc", "2", "d", "25"), ("3", "1", "p", "", "2", "d", "25"),
                   ("4", "1", "p", None, "2", "d", "25"), ("5", "1", "p", "1e2", "2.0", "d", "25"))
    got = q.coerce_numeric(df)
    assert rows(got.select("id_purchase", F.col("price").cast("double"), "quantity")) == [
        (1, 12.5, 2), (5, 100.0, 2)]


@pytest.mark.parametrize("least,kept", [(0, [0, 1]), (1, [1])])
def test_negative(spark, least, kept):
    df = spark.createDataFrame([(1.0, -1), (1.0, 0), (1.0, 1), (-1.0, 1)], "price double, quantity int")
    assert sorted(r.quantity for r in q.reject_negative(df, least).collect()) == kept


def test_trim_takes_all_blanks(spark, rows):
    df = spark.createDataFrame([("\t A b\u00a0\n",)], "name string")
    assert rows(q.normalize_strings(df, lower=["name"])) == [("a b",)]


def test_tokens_for_missing_values(spark, rows):
    df = spark.createDataFrame([("NA", 1), ("", 2), ("n/a ", 3), (None, 4), ("Nan", 5)], "t string, i int")
    assert rows(q.tokens_to_null(df)) == [("Nan", 5), ("n/a ", 3), (None, 1), (None, 2), (None, 4)]
    assert q.tokens_to_null(df, ()) is df


def test_dedup_does_not_depend_on_input_order(spark, rows):
    data = [(1, "b"), (1, "a"), (2, "c"), (1, "a")]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "k int, v string").repartition(3)
        assert rows(q.dedup_by_key(df, "k", ["v"])) == [(1, "a"), (2, "c")]


def test_dedup_shrinks_a_hot_key_before_the_shuffle(spark):
    hot = spark.range(20_000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.col("id").cast("string").alias("v"))
    plan = q.dedup_by_key(hot, "k", ["v"])._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[exchange:]
    assert q.dedup_by_key(hot, "k", ["v"]).count() == hot.select("k").distinct().count()


def test_semi_and_anti_split_the_input(spark):
    p = spark.createDataFrame([(1,), (2,), (2,), (9,)], "id_client int")
    ids = spark.createDataFrame([(1,), (2,)], "id_client int")
    assert q.orphan_semi_join(p, ids).count() == 3
    assert q.orphan_rejects(p, ids).count() == 1


def test_clean_clients_order_of_checks(spark, rows):
    raw = clients(spark,
                  ("1", " Ann ", "Ann@x.com", "2024-01-01", "FR "),
                  ("1", "Ann2", "ann2@x.com", "2024-02-01", "FR"),     # later copy of the id
                  ("2", "Bob", "Ann@x.com", "2024-01-03", "FR"),       # same address, higher id
                  ("3", "Cid", "ann@X.com", "2030-01-01", "DE"),       # differs in case: stays
                  ("4", None, "d@x.com", "2024-01-01", "DE"),
                  ("5", "Eve", " e@x.com", "2024-01-01", "DE"),
                  ("6", "Fay", "f@x.com", "never", "DE"),
                  ("x", "Gil", "g@x.com", "2024-01-01", "DE"))
    assert rows(silver.clean_clients(raw, TODAY)) == [
        (1, "Ann", "ann@x.com", date(2024, 1, 1), "FR"),
        (3, "Cid", "ann@x.com", TODAY, "DE")]
    assert dict(rows(silver.quality_clients(raw, TODAY))) == {
        "initial_rows": 8, "null_values": 1, "invalid_dates": 1, "future_dates_fixed": 1,
        "invalid_emails": 1, "invalid_numbers": 1, "duplicates_removed": 2, "final_rows": 2}


def test_clean_purchases_and_report(spark, rows):
    raw = purchases(spark,
                    ("1", "1", " p", "2.50", "2", "2024-01-01", "9.99"),
                    ("1", "1", "p", "2.50", "2", "2024-01-02", "5.00"),
                    ("2", "7", "p", "1", "1", "2024-01-01", "1"),      # orphan
                    ("3", "1", "p", "1", "-1", "2024-01-01", "1"),
                    ("4", "1", "p", "1", "0", "2030-01-01", "0"),
                    ("5", "1", None, "1", "1", "bad", "1"),
                    ("6", "1", "p", "1", "1", "bad", "1"),
                    ("7", "1", "p", "one", "1", "2024-01-01", "1"),
                    ("8", "1", "p", "9999999999999999", "2000", "2024-01-01", "1"))
    ids = spark.createDataFrame([(1,)], "id_client bigint")
    clean = silver.clean_purchases(raw, ids, TODAY)
    assert rows(clean.select("id_purchase", "product", F.col("total").cast("double"),
                             "purchase_date")) == [
        (1, "p", 5.0, date(2024, 1, 1)), (4, "p", 0.0, TODAY)]
    assert silver.clean_purchases(raw, ids, TODAY, min_quantity=1).count() == 1
    assert dict(rows(silver.quality_purchases(raw, ids, TODAY))) == {
        "initial_rows": 9, "null_values": 1, "invalid_dates": 1, "future_dates_fixed": 1,
        "invalid_numbers": 2, "negative_values": 1, "total_recalculated": 1,
        "orphan_purchases": 1, "duplicates_removed": 1, "final_rows": 2}
    report = silver.quality_report(
        silver.client_quality_row(clients(spark, ("1", "A", "a@b.co", "2024-01-01", "FR")), TODAY),
        silver.purchase_quality_row(raw, ids, TODAY)).first()
    assert report.purchases.null_values_by_column == {"product": 1}
    assert report.clients.null_values_by_column == {}
    assert report.summary.data_quality_score == 30.0


def test_golden_waterfall(spark, golden, rows):
    raw_clients = starschema.dirty_clients(spark, golden)
    valid = silver.clean_clients(raw_clients, checks.AS_OF)
    got = dict(rows(silver.quality_clients(raw_clients, checks.AS_OF)))
    assert got == {"initial_rows": 1525, "null_values": 17, "invalid_dates": 20,
                   "future_dates_fixed": 23, "invalid_emails": 16, "invalid_numbers": 0,
                   "duplicates_removed": 38, "final_rows": 1434}
    raw = starschema.dirty_purchases(spark, golden)
    got = dict(rows(silver.quality_purchases(raw, valid, checks.AS_OF)))
    assert got == {"initial_rows": 60000, "null_values": 557, "invalid_dates": 2751,
                   "future_dates_fixed": 1348, "invalid_numbers": 0, "negative_values": 984,
                   "total_recalculated": 2265, "orphan_purchases": 3305,
                   "duplicates_removed": 12336, "final_rows": 40067}
    drops = ["null_values", "invalid_dates", "invalid_numbers", "negative_values",
             "orphan_purchases", "duplicates_removed"]
    assert got["initial_rows"] - sum(got[d] for d in drops) == got["final_rows"]
    clean = silver.clean_purchases(raw, valid, checks.AS_OF)
    assert clean.agg(F.count_if(F.col("quantity") == 0), F.sum("total").cast("double"),
                     F.countDistinct("id_client")).first()[:] == (856, 946120334.23, 1434)


def test_numbers_and_dates_that_used_to_be_lost(spark, rows):
    raw = purchases(spark,
                    ("1.0", "1.0", "p", "12.345", "2", "2024-01-01", "24.69"),
                    ("2", "1", "p", "1.00", "3000000000", " 2024-01-01 ", "3000000000"),
                    ("3", "1", "p", "1", "1", "2024", "1"), ("4", "1", "p", "1", "1", "2024-01", "1"),
                    ("5", "1", "p", "1", "1", "2024-01-02 garbage", "1"),
                    ("6", "1", "p", "1", "1", "2024-1-2", "1"), ("7", "1", "p", "1", "1", "2024-02-30", "1"))
    ids = spark.createDataFrame([(1,)], "id_client bigint")
    clean = silver.clean_purchases(raw, ids, TODAY)
    assert rows(clean.select("id_purchase", "quantity", F.col("total").cast("double"))) == [
        (1, 2, 24.69), (2, 3_000_000_000, 3e9)]
    report = dict(rows(silver.quality_purchases(raw, ids, TODAY)))
    assert (report["invalid_dates"], report["total_recalculated"], report["final_rows"]) == (5, 0, 2)


def test_fractions_are_no_whole_numbers(spark):
    """A fraction is never cut: the row goes and is counted; 2.0 is 2."""
    rows = [("1", "1", "p", "1.25", "2.9", "2024-01-01", "3.63"), ("2", "1", "p", "1.25", "2.0", "2024-01-01", "2.50"),
            ("3.7", "1", "p", "1", "1", "2024-01-01", "1"), ("4.0", "1.000", "p", "1", "3", "2024-01-01", "3"),
            ("5", "1.5", "p", "1", "1", "2024-01-01", "1"), ("6", "1", "p", "1", "2.0000000001", "2024-01-01", "2")]
    bronze = purchases(spark, *rows)
    clients = spark.createDataFrame([(1,)], "id_client bigint")
    kept = silver.clean_purchases(bronze, clients, date(2024, 6, 1)).collect()
    assert sorted((r.id_purchase, r.id_client, r.quantity, float(r.total)) for r in kept) == [(2, 1, 2, 2.5), (4, 1, 3, 3.0)]
    metrics = {r.metric: r.value for r in silver.quality_purchases(bronze, clients, date(2024, 6, 1)).collect()}
    assert (metrics["invalid_numbers"], metrics["final_rows"], metrics["total_recalculated"]) == (4, 2, 0)
    assert q.coerce_numeric(bronze).count() == 2


def test_cents_are_exact(spark):
    amounts = ["99999999999999.99", "-99999999999999.99", "9999999999999.99", "10000000000000.01", "0.29", "-0.01",
               "9999999999999999.99", "70368744177664.29"]
    df = spark.createDataFrame([(Decimal(a),) for a in amounts], "v decimal(18,2)")
    assert [r[0] for r in df.select(cents("v")).collect()] == [int(Decimal(a) * 100) for a in amounts]
