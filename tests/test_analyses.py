"""Edges of the analyses, on small tables and against plain Python."""

import random
from collections import Counter, defaultdict
from datetime import date, timedelta
from decimal import Decimal

import pytest
from storeloom.checks import queries as checks
from storeloom.functions.selection import tiles
from storeloom.operators import analyses

DAY = date(2024, 1, 1)
COLUMNS = ("id_purchase bigint, id_client bigint, product string, price decimal(18,2), quantity bigint, "
           "purchase_date date, total decimal(18,2)")


def _sales(spark, rows):
    """(client, product, days after the first, total)"""
    return spark.createDataFrame(
        [(n, c, p, Decimal(t), 1, None if d is None else DAY + timedelta(days=d), Decimal(t))
         for n, (c, p, d, t) in enumerate(rows)], COLUMNS)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- cross-sell --------------------------------------------------------------

def _rules(rows, min_support):
    baskets = defaultdict(set)
    for c, p, d, _ in rows:
        if None not in (c, p, d):
            baskets[c, d].add(p)
    singles, pairs = Counter(), Counter()
    for held in baskets.values():
        singles.update(held)
        pairs.update((x, y) for x in held for y in held if x != y)
    n = len(baskets)
    return {(x, y): (k, round(k / n, 6), round(k / singles[x], 6), round(k * n / singles[x] / singles[y], 6))
            for (x, y), k in pairs.items() if k >= min_support * n}


@pytest.mark.parametrize("chunk", [256, 3])
def test_cross_sell(spark, chunk):
    rng = random.Random(3)
    rows = [(rng.randrange(30), f"p{rng.randrange(12)}", rng.randrange(4), 1) for _ in range(400)]
    # One basket with a third of all rows, repeated products and rows in no basket.
    rows += [(99, f"p{i}", 0, 1) for i in range(200)] + [(1, None, 0, 1), (None, "p1", 0, 1), (1, "p1", None, 1)]
    for support in (0.0, 0.02, 0.1, 1.1):
        got = {(r["product"], r.also_bought): (r.baskets, r.support, r.confidence, r.lift)
               for r in analyses.cross_sell(_sales(spark, rows), support, chunk).collect()}
        want = _rules(rows, support)
        assert got.keys() == want.keys()
        assert all(got[k] == pytest.approx(want[k], abs=2e-6) for k in want)


def test_a_large_basket_is_split(spark):
    items = analyses.basket_items(_sales(spark, [(1, f"p{i}", 0, 1) for i in range(100)]))
    groups = Counter((r.low, r.high) for r in analyses._chunked(items, 10).collect())
    assert len(groups) == 55 and max(groups.values()) < 50


def test_empty(spark):
    none = _sales(spark, [])
    clients = spark.createDataFrame([], "id_client bigint, country string")
    for out in (analyses.cross_sell(none), analyses.spells(none, DAY), analyses.retention_curve(none, DAY),
                analyses.cohort_matrix(none, DAY), analyses.box_plots(none), analyses.sales_anomalies(none, clients),
                analyses.revenue_forecast(none, clients, DAY)):
        assert out.collect() == []


# --- retention and cohorts -----------------------------------------------------

def test_spells_and_censoring(spark):
    rows = [(1, "a", 0, 1), (1, "a", 0, 1), (1, "a", 90, 1), (1, "a", 181, 1), (2, "a", 150, 1), (3, "a", 10, 1),
            (None, "a", 5, 1), (4, "a", None, 1), (5, "a", 999, 1)]
    as_of = DAY + timedelta(days=200)
    got = {(r.id_client, r.spell): ((r.start - DAY).days, (r.stop - DAY).days, r.orders, r.ended)
           for r in analyses.spells(_sales(spark, rows), as_of).collect()}
    # 90 days apart is one spell, 91 are two; what goes on at the end is not ended.
    assert got == {(1, 1): (0, 90, 3, True), (1, 2): (181, 181, 1, False), (2, 1): (150, 150, 1, False),
                   (3, 1): (10, 10, 1, True)}
    curve = [tuple(r) for r in analyses.retention_curve(_sales(spark, rows), as_of).orderBy("age").collect()]
    assert curve == [(0, 4, 1, 2, 0.25, 0.75), (1, 1, 0, 0, 0.0, 0.75), (2, 1, 0, 0, 0.0, 0.75), (3, 1, 1, 0, 1.0, 0.0)]


def test_cohorts_have_empty_cells(spark):
    rows = [(1, "a", 0, 1), (1, "b", 1, 2), (2, "a", 3, 1), (1, "a", 65, 5), (3, "a", 40, 1), (3, "a", 400, 1)]
    out = analyses.cohort_matrix(_sales(spark, rows), date(2024, 4, 30))
    got = [tuple(r) for r in out.orderBy("cohort", "age").collect()]
    assert got == [("2024-01", 0, 2, 2, 100.0, 3, 4.0), ("2024-01", 1, 2, 0, 0.0, 0, 0.0), ("2024-01", 2, 2, 1, 50.0, 1, 5.0),
                   ("2024-01", 3, 2, 0, 0.0, 0, 0.0), ("2024-02", 0, 1, 1, 100.0, 1, 1.0), ("2024-02", 1, 1, 0, 0.0, 0, 0.0),
                   ("2024-02", 2, 1, 0, 0.0, 0, 0.0)]


@pytest.mark.parametrize("name", ["cross_sell", "retention_curve", "cohort_matrix", "box_plots", "sales_anomalies",
                                  "revenue_forecast"])
def test_plans(spark, sf, name):
    plan = _plan(checks.queries()[name](spark, sf))
    assert "Expand" not in plan and "CartesianProduct" not in plan and "Python" not in plan


# --- n-tiles -------------------------------------------------------------------

@pytest.mark.parametrize("n, groups", [(0, 5), (3, 5), (23, 5), (100, 7)])
def test_tiles(spark, n, groups):
    # Ties in the value, in many partitions.
    rows = [(i, i * 7 % 4) for i in range(n)]
    out = tiles(spark.createDataFrame(rows, "id int, v int").repartition(8), ["v", "id"], groups, "tile")
    small, larger = divmod(n, groups)
    want, at = {}, 0
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    for tile in range(groups):
        size = small + (tile < larger)
        want |= {i: tile + 1 for i, _ in order[at:at + size]}
        at += size
    assert {r.id: r.tile for r in out.collect()} == want


def test_rfm_has_no_single_partition(spark, sf):
    assert "SinglePartition" not in _plan(checks.queries()["rfm_scores"](spark, sf))


# --- distributions ----------------------------------------------------------------

def test_box_plot(spark):
    rows = [(1, "a", 0, v) for v in (1, 2, 3, 4, 5, 6, 7, 8, 100, -50)] + [(1, None, 0, 5)]
    got = {r["product"]: tuple(r)[1:] for r in analyses.box_plots(_sales(spark, rows)).collect()}
    assert got == {"a": (10, 2.25, 4.5, 6.75, 1.0, 8.0, 1, 1), None: (1, 5.0, 5.0, 5.0, 5.0, 5.0, 0, 0)}


def test_planted_anomalies_are_found(spark):
    rng = random.Random(1)
    rows = [(c, "a", d, 1000 + rng.randrange(100)) for c in (1, 2) for d in range(140)]
    rows += [(1, "a", 30, 5000), (3, "a", 0, 7), (3, "a", 7, 7), (3, "a", 14, 7), (3, "a", 21, 8)]
    clients = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id_client bigint, country string")
    got = {(r.country, (r.date - DAY).days): r.score for r in analyses.sales_anomalies(_sales(spark, rows), clients).collect()}
    assert got.keys() == {("x", 30), (None, 21)} and got["x", 30] > 3.5 and got[None, 21] is None


def test_forecast_of_a_pure_season(spark):
    """A series that only repeats its week is forecast exactly; a short one by its mean and season."""
    rows = [(1, "a", d, 100 + 10 * (d % 7)) for d in range(70)] + [(2, "a", 67, 30), (2, "a", 69, 60)]
    clients = spark.createDataFrame([(1, "x"), (2, "y")], "id_client bigint, country string")
    out = analyses.revenue_forecast(_sales(spark, rows), clients, DAY + timedelta(days=69), horizon=9).collect()
    got = {(r.country, (r.date - DAY).days): r.forecast for r in out}
    assert all(got["x", d] == 100 + 10 * (d % 7) for d in range(70, 79))
    # Days 67 to 69 are 30, 0 and 60; the season's other places are empty.
    assert [got["y", d] for d in range(70, 79)] == [30, 30, 30, 30, 30, 0, 60, 30, 30]
