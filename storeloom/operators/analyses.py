"""Customer and basket analyses: cross-sell, retention, cohorts, RFM scores, box plots, anomalies."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from storeloom.functions.calendar import days_between, month_start, year_month
from storeloom.functions.numeric import cents, from_cents, ratio, round2
from storeloom.functions.selection import exact_quantiles, tiles
from storeloom.operators.kpis import ACTIVE_DAYS

#: Products of a basket that are paired by one group of rows; larger baskets are split.
CHUNK = 256
MONTH_DAYS = 30


def _share(numerator: Column, denominator: Column) -> Column:
    """A quotient to six digits; NULL on a zero denominator."""
    quotient = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return F.round(quotient.cast("decimal(38,10)"), 6).cast("double")


# --- cross-sell --------------------------------------------------------------

def basket_items(sales: DataFrame) -> DataFrame:
    """Each product of each basket once; a basket is what a client buys on a day."""
    known = F.col("id_client").isNotNull() & F.col("purchase_date").isNotNull() & F.col("product").isNotNull()
    return sales.filter(known).select("id_client", "purchase_date", "product").distinct()


def _chunked(items: DataFrame, chunk: int) -> DataFrame:
    """Items with the pairs of chunks, ``low`` and ``high``, whose products meet.

    A basket of up to ``chunk`` products is one chunk. One of c chunks has
    c * (c + 1) / 2 pairs of them, each a group of its own of at most twice the
    chunk's size on average, so a very large basket is spread over many tasks.
    """
    sizes = items.groupBy("id_client", "purchase_date").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(chunk)).cast("int").alias("chunks"), F.count(F.lit(1)).alias("size"))
    placed = items.join(sizes.filter("size > 1"), ["id_client", "purchase_date"]).withColumn(
        "own", F.pmod(F.xxhash64("product"), F.col("chunks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    return placed.select("id_client", "purchase_date", "product", "own", other).select(
        "id_client", "purchase_date", "product", "own",
        F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))


def cross_sell(sales: DataFrame, min_support: float = 0.01, chunk: int = CHUNK) -> DataFrame:
    """Rules between two products that are bought together in at least ``min_support`` of all baskets.

    Level by level: products below the support can be in no frequent pair and
    leave before baskets are paired. Pairs are counted on the map side of the
    join's output. Returns ``product``, ``also_bought``, ``baskets`` with both,
    ``support``, ``confidence`` (of ``also_bought`` given ``product``) and
    ``lift``. Rows without client, date or product are in no basket; a basket of
    one product counts for the supports.
    """
    items = basket_items(sales)
    baskets = items.select("id_client", "purchase_date").distinct().agg(F.count(F.lit(1))).scalar()
    enough = F.col("n") >= baskets * F.lit(min_support)
    singles = items.groupBy("product").agg(F.count(F.lit(1)).alias("n")).filter(enough)
    placed = _chunked(items.join(singles.select("product"), "product", "left_semi"), chunk)
    a, b = placed.alias("a"), placed.alias("b")
    meet = F.col("a.product") < F.col("b.product")
    for key in ("id_client", "purchase_date", "low", "high"):
        meet = meet & (F.col(f"a.{key}") == F.col(f"b.{key}"))
    # Two chunks pair their products with each other's, and a chunk with itself its own.
    meet = meet & ((F.col("a.own") != F.col("b.own")) | (F.col("a.low") == F.col("a.high")))
    pairs = a.join(b, meet).groupBy(F.col("a.product").alias("x"), F.col("b.product").alias("y")).agg(
        F.count(F.lit(1)).alias("n")).filter(enough)
    both = F.array(F.struct(F.col("x").alias("product"), F.col("y").alias("also_bought")),
                   F.struct(F.col("y").alias("product"), F.col("x").alias("also_bought")))
    rules = pairs.select(F.inline(both), "n")
    return (rules.join(singles.select("product", F.col("n").alias("n_product")), "product")
            .join(singles.select(F.col("product").alias("also_bought"), F.col("n").alias("n_also")), "also_bought")
            .select("product", "also_bought", F.col("n").alias("baskets"), _share(F.col("n"), baskets).alias("support"),
                    _share(F.col("n"), F.col("n_product")).alias("confidence"),
                    _share(F.col("n").cast("double") * baskets, F.col("n_product").cast("double") * F.col("n_also"))
                    .alias("lift")))


# --- retention ---------------------------------------------------------------

def spells(sales: DataFrame, as_of: date, gap_days: int = ACTIVE_DAYS) -> DataFrame:
    """Times in which a client keeps buying: gaps of at most ``gap_days`` between purchases.

    Returns ``id_client``, ``spell`` (from 1), ``start``, ``stop`` (the last
    purchase), ``orders`` and ``ended``: whether more than ``gap_days`` have
    passed since. A spell that goes on at ``as_of`` is censored, not ended.
    Purchases after ``as_of`` and rows without client or date take no part.

    The window over a client sees one row per day, whatever the client buys.
    """
    days = (sales.filter(F.col("id_client").isNotNull() & (F.col("purchase_date") <= F.lit(as_of)))
            .groupBy("id_client", "purchase_date").agg(F.count(F.lit(1)).alias("orders")))
    along = Window.partitionBy("id_client").orderBy("purchase_date")
    gap = days_between(F.col("purchase_date"), F.lag("purchase_date").over(along))
    marked = days.withColumn("begins", F.coalesce(gap > gap_days, F.lit(True)).cast("int"))
    numbered = marked.withColumn("spell", F.sum("begins").over(along))
    return numbered.groupBy("id_client", "spell").agg(
        F.min("purchase_date").alias("start"), F.max("purchase_date").alias("stop"),
        F.sum("orders").alias("orders")).withColumn(
        "ended", days_between(F.lit(as_of), F.col("stop")) > gap_days)


def retention_curve(sales: DataFrame, as_of: date, gap_days: int = ACTIVE_DAYS,
                    month_days: int = MONTH_DAYS) -> DataFrame:
    """How many of all spells last to each age, with those that go on counted as censored.

    Per age in months of ``month_days``, from 0 to the longest: spells
    ``at_risk``, those ``ended`` and ``censored`` at that age, the ``hazard``
    (ended / at risk) and ``survival``, the product of 1 - hazard up to this age.
    """
    age = F.floor(days_between(F.col("stop"), F.col("start")) / F.lit(month_days)).cast("int")
    counted = spells(sales, as_of, gap_days).groupBy(age.alias("age")).agg(
        F.count_if("ended").alias("ended"), F.count_if(~F.col("ended")).alias("censored"))
    # One row per month of age from here on.
    ages = counted.agg(F.max("age").alias("last")).select(
        F.explode(F.sequence(F.lit(0), F.col("last"))).alias("age"))
    dense = ages.join(counted, "age", "left").na.fill(0)
    later = Window.orderBy("age").rowsBetween(0, Window.unboundedFollowing)
    risk = dense.withColumn("at_risk", F.sum(F.col("ended") + F.col("censored")).over(later))
    kept = F.product(1 - F.try_divide(F.col("ended").cast("double"), F.col("at_risk").cast("double"))).over(
        Window.orderBy("age").rowsBetween(Window.unboundedPreceding, 0))
    return risk.select("age", "at_risk", "ended", "censored", _share(F.col("ended"), F.col("at_risk")).alias("hazard"),
                       F.round(kept.cast("decimal(38,10)"), 6).cast("double").alias("survival"))


# --- cohorts -----------------------------------------------------------------

def _month_number(month: Column) -> Column:
    return F.year(month) * 12 + F.month(month)


def client_months(sales: DataFrame) -> DataFrame:
    """One row per client and month, with its orders and revenue in cents."""
    return (sales.filter(F.col("id_client").isNotNull() & F.col("purchase_date").isNotNull())
            .groupBy("id_client", month_start(F.col("purchase_date")).alias("month"))
            .agg(F.count("id_purchase").alias("orders"), F.sum(cents("total")).alias("revenue")))


def cohort_matrix(sales: DataFrame, as_of: date) -> DataFrame:
    """Clients by the month of their first purchase, and how many buy again at each age in months.

    A cell for every cohort and age up to the month of ``as_of``, also where
    nobody bought: ``cohort``, ``age``, ``clients`` of the cohort, ``active`` at
    that age, ``retention_pct``, ``orders`` and ``revenue``. A (client, month)
    is one row, so clients are a plain count. Purchases after ``as_of`` take no part.
    """
    months = client_months(sales.filter(F.col("purchase_date") <= F.lit(as_of)))
    first = F.min("month").over(Window.partitionBy("id_client"))
    aged = months.withColumn("cohort", first).withColumn(
        "age", _month_number(F.col("month")) - _month_number(F.col("cohort")))
    cells = aged.groupBy("cohort", "age").agg(
        F.count(F.lit(1)).alias("active"), F.sum("orders").alias("orders"), F.sum("revenue").alias("cents"))
    # A cell per pair of months from here on.
    last = _month_number(F.lit(as_of))
    grid = cells.filter("age = 0").select("cohort", F.col("active").alias("clients"), F.explode(
        F.sequence(F.lit(0), last - _month_number(F.col("cohort")))).alias("age"))
    zero = F.lit(0).cast("bigint")
    return (grid.join(cells, ["cohort", "age"], "left")
            .select(year_month(F.col("cohort")).alias("cohort"), "age", "clients",
                    F.coalesce("active", zero).alias("active"),
                    ratio(F.coalesce("active", zero) * 100, F.col("clients")).alias("retention_pct"),
                    F.coalesce("orders", zero).alias("orders"),
                    from_cents(F.coalesce("cents", zero)).alias("revenue")))


# --- RFM ---------------------------------------------------------------------

def rfm_scores(kpis: DataFrame, groups: int = 5) -> DataFrame:
    """Recency, frequency and spend of each client as exact n-tiles, ``groups`` the best.

    ``kpis`` has ``id_client``, ``days_since_last_purchase``, ``total_purchases``
    and ``total_spent``, one row per client. Ties are in the order of the id, so
    the tiles are of equal size. Returns these and ``r_score``, ``f_score``,
    ``m_score``, ``rfm`` (the three digits) and ``rfm_total``.
    """
    rows = kpis.select("id_client", "days_since_last_purchase", "total_purchases", "total_spent",
                       (-F.col("days_since_last_purchase")).alias("_recent"))
    for column, score in (("_recent", "r_score"), ("total_purchases", "f_score"), ("total_spent", "m_score")):
        rows = tiles(rows, [column, "id_client"], groups, score)
    scores = [F.col(c) for c in ("r_score", "f_score", "m_score")]
    return rows.select("id_client", "days_since_last_purchase", "total_purchases", "total_spent", *scores,
                       F.concat(*[s.cast("string") for s in scores]).alias("rfm"),
                       (scores[0] + scores[1] + scores[2]).alias("rfm_total"))


# --- distributions -----------------------------------------------------------

def box_plots(sales: DataFrame, value: str = "total", by: str = "product", reach: float = 1.5) -> DataFrame:
    """Five numbers and outliers of ``value`` per group, as a box plot draws them.

    Quartiles first, exact; then one scan against the fences ``reach``
    interquartile ranges beyond them: ``whisker_low`` and ``whisker_high`` are
    the outermost values within, ``outliers_low`` and ``outliers_high`` how many
    lie outside. NULL values take no part; a NULL group is one.
    """
    quartiles = exact_quantiles(sales, value, [0.25, 0.5, 0.75], [by])
    q1, q2, q3 = (F.element_at("quantiles", i) for i in (1, 2, 3))
    fences = quartiles.select(F.col(by).alias("_by"), q1.alias("q1"), q2.alias("median"), q3.alias("q3"),
                              (q1 - reach * (q3 - q1)).alias("_low"), (q3 + reach * (q3 - q1)).alias("_high"))
    x = F.col(value).cast("double")
    rows = sales.filter(F.col(value).isNotNull()).select(by, x.alias("_x")).join(
        fences, F.col(by).eqNullSafe(F.col("_by")))
    inside = F.col("_x").between(F.col("_low"), F.col("_high"))
    same = [F.first(c).alias(c) for c in ("q1", "median", "q3")]
    out = rows.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"), *same, F.min(F.when(inside, F.col("_x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_x"))).alias("whisker_high"),
        F.count_if(F.col("_x") < F.col("_low")).alias("outliers_low"),
        F.count_if(F.col("_x") > F.col("_high")).alias("outliers_high"))
    return out.withColumns({c: round2(F.col(c)) for c in ("q1", "median", "q3")})


def sales_anomalies(sales: DataFrame, clients: DataFrame, threshold: float = 3.5) -> DataFrame:
    """Days on which a country's revenue is far from what it is on that weekday.

    Far is a modified z-score above ``threshold``: 0.6745 times the distance
    from the median, over the median of these distances, both of the country's
    same weekdays that have sales. Where that is 0, any other value is an
    anomaly, with a NULL score. Returns ``country``, ``date``, ``weekday``
    (Monday = 0), ``revenue``, ``expected`` and ``score``. Clients without a
    country are a group of their own.
    """
    # Per client and day before the join, so it is free of a hot client.
    spent = sales.filter(F.col("purchase_date").isNotNull()).groupBy("id_client", "purchase_date").agg(
        F.sum(cents("total")).alias("cents"))
    daily = (spent.join(clients.select("id_client", "country"), "id_client", "left")
             .groupBy("country", F.col("purchase_date").alias("date")).agg(F.sum("cents").alias("cents"))
             .withColumn("weekday", F.weekday("date")))
    by = ["country", "weekday"]

    def with_median(rows: DataFrame, value: str, name: str) -> DataFrame:
        found = exact_quantiles(rows, value, [0.5], by).select(
            F.col("country").alias("_country"), F.col("weekday").alias("_weekday"),
            F.element_at("quantiles", 1).alias(name))
        return rows.join(found, F.col("country").eqNullSafe(F.col("_country"))
                         & (F.col("weekday") == F.col("_weekday"))).drop("_country", "_weekday")

    centred = with_median(daily, "cents", "middle").withColumn("far", F.abs(F.col("cents") - F.col("middle")))
    judged = with_median(centred, "far", "spread")
    score = F.try_divide(F.lit(0.6745) * (F.col("cents") - F.col("middle")), F.col("spread"))
    odd = F.when(F.col("spread") == 0, F.col("far") > 0).otherwise(F.abs(score) > threshold)
    return judged.filter(odd).select(
        "country", "date", "weekday", from_cents(F.col("cents")).alias("revenue"),
        round2(F.col("middle") / 100).alias("expected"), round2(score).alias("score"))


# --- forecast ----------------------------------------------------------------

def daily_by_country(sales: DataFrame, clients: DataFrame, as_of: date) -> DataFrame:
    """Revenue in cents per country and day, 0 on days without sales up to ``as_of``."""
    spent = sales.filter(F.col("purchase_date") <= F.lit(as_of)).groupBy("id_client", "purchase_date").agg(
        F.sum(cents("total")).alias("cents"))
    daily = (spent.join(clients.select("id_client", "country"), "id_client", "left")
             .groupBy("country", F.col("purchase_date").alias("date")).agg(F.sum("cents").alias("cents")))
    days = daily.groupBy(F.col("country").alias("_country")).agg(F.min("date").alias("first")).select(
        "_country", F.explode(F.sequence("first", F.lit(as_of), F.expr("INTERVAL 1 DAY"))).alias("_date"))
    same = F.col("country").eqNullSafe(F.col("_country")) & (F.col("date") == F.col("_date"))
    return days.join(daily, same, "left").select(
        F.col("_country").alias("country"), F.col("_date").alias("date"),
        F.coalesce("cents", F.lit(0).cast("bigint")).alias("cents"))


def revenue_forecast(sales: DataFrame, clients: DataFrame, as_of: date, horizon: int = 14, period: int = 7,
                     alpha: float = 0.2, gamma: float = 0.1) -> DataFrame:
    """Revenue per country and day after ``as_of``, by exponential smoothing with a season of ``period`` days.

    The first ``period`` days of a country's series give level and season to
    start with; each later day moves them by ``alpha`` and ``gamma``. A series
    has one number for each day of the calendar, however many sales there are,
    and is folded in the order of days inside the JVM. Returns ``country``,
    ``date``, ``forecast`` and ``level``.
    """
    series = daily_by_country(sales, clients, as_of).groupBy("country").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("date", "cents"))), lambda x: x["cents"] / 100).alias("x"))
    head = F.slice("x", 1, period)
    level = F.aggregate(head, F.lit(0.0), lambda s, v: s + v) / F.size(head)
    started = series.withColumn("level0", level).withColumn("seasons0", F.transform(
        F.sequence(F.lit(0), F.lit(period - 1)),
        lambda i: F.when(i < F.size("x"), F.get("x", i) - F.col("level0")).otherwise(F.lit(0.0))))

    def step(state: Column, x: Column) -> Column:
        place = state["day"] % period
        season = F.get(state["seasons"], place)
        moved = alpha * (x - season) + (1 - alpha) * state["level"]
        again = gamma * (x - moved) + (1 - gamma) * season
        return F.struct((state["day"] + 1).alias("day"), moved.alias("level"), F.transform(
            state["seasons"], lambda s, i: F.when(i == place, again).otherwise(s)).alias("seasons"))

    first = F.struct(F.size(head).alias("day"), F.col("level0").alias("level"), F.col("seasons0").alias("seasons"))
    rest = F.slice("x", F.lit(period + 1), F.size("x"))
    ended = started.select("country", F.aggregate(rest, first, step).alias("state"))
    ahead = F.explode(F.sequence(F.lit(0), F.lit(horizon - 1))).alias("ahead")
    value = F.col("state.level") + F.get("state.seasons", (F.col("state.day") + F.col("ahead")) % period)
    return ended.select("country", "state", ahead).select(
        "country", F.date_add(F.lit(as_of), F.col("ahead") + 1).alias("date"), round2(value).alias("forecast"),
        round2(F.col("state.level")).alias("level"))
