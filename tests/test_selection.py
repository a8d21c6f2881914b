"""The distributed order statistics against a sort in memory."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from storeloom.functions import selection as s

PROBS = [0.0, 0.25, 0.5, 0.75, 0.9, 0.95, 1.0]

CASES = {
    "four": [1, 2, 3, 10],
    "one": [7],
    "ties": [5.0] * 50 + [1.0, 9.0],
    "negative": [-3.5, -1000000.25, 0.0, 2.5, 1e-9, -1e-9],
    "wide": [random.Random(1).uniform(-1, 1) * 10 ** random.Random(i).randint(-3, 12)
             for i in range(500)],
    "cents": [round(random.Random(2).gauss(24000, 9000), 2) for _ in range(1)]
             + [round(random.Random(i).gauss(24000, 9000), 2) for i in range(2000)],
    "hot": [42.0] * 700 + [float(i) for i in range(1400)],
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_quantiles(spark, name):
    values = [float(v) for v in CASES[name]]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(5)
    got = s.exact_quantiles(df, "v", PROBS).first().quantiles
    assert got == pytest.approx(list(np.quantile(values, PROBS)), rel=1e-12, abs=1e-9)


def test_groups_including_a_null_group(spark):
    data = [("a", float(i)) for i in range(10)] + [(None, 4.0), (None, 8.0)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r.g: r.quantiles for r in s.exact_quantiles(df, "v", [0.5], ["g"]).collect()}
    assert got == {"a": [4.5], None: [6.0]}


def test_no_rows(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert s.exact_median(df, "v").count() in (0, 1)
    assert spark.range(1).select(s.exact_median(df, "v").scalar()).first()[0] is None


def test_approximate_is_close(spark):
    df = spark.range(10_001).select(F.col("id").cast("double").alias("v"))
    assert s.exact_median(df, "v", approx=True).first().median == pytest.approx(5000, abs=5)


def test_buckets_are_monotone(spark):
    values = sorted(CASES["wide"] + CASES["cents"] + CASES["negative"])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = [r.b for r in df.orderBy("v").select(s.magnitude_bucket(F.col("v")).alias("b")).collect()]
    assert got == sorted(got)


@pytest.mark.parametrize("label", [None, "y"])
def test_split_is_exact_and_repeatable(spark, label):
    df = spark.range(1001).select("id", F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("y"))
    one = s.hash_split(df, "id", 0.75, 42, label)
    two = s.hash_split(df.repartition(7), "id", 0.75, 42, label)
    flags = {r.id: r.is_train for r in one.collect()}
    assert flags == {r.id: r.is_train for r in two.collect()}
    assert flags != {r.id: r.is_train for r in s.hash_split(df, "id", 0.75, 43, label).collect()}
    if label is None:
        assert sum(flags.values()) == 750
    else:
        per = {r.y: r.n for r in one.where("is_train").groupBy("y").agg(
            F.count("id").alias("n")).collect()}
        assert per == {0: 675, 1: 75}


def test_counts_are_shuffled_once(spark):
    df = spark.range(5000).select((F.col("id") % 997).cast("double").alias("v"))
    found = s.exact_quantiles(df, "v", [0.5])
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan


def test_a_narrow_range_takes_several_buckets(spark):
    """200,000 different values in a range that the first buckets do not tell apart."""
    df = spark.range(200_000, numPartitions=8).select((1000 + F.col("id") * 5e-7).alias("v"), (F.col("id") % 2).alias("g"))
    assert df.select(s.magnitude_bucket(F.col("v"))).distinct().count() <= 2
    rows = df.select("v").withColumnRenamed("v", "value")
    wanted = df.agg(F.lit(0).alias("i"), F.min("v").alias("low"), F.max("v").alias("high"), F.lit(0).alias("before"),
                    F.lit(0).alias("rank"), F.count("v").alias("n"))
    place = F.floor((F.col("value") - F.col("x.low")) / (F.col("x.high") - F.col("x.low")) * s._SPLITS)
    sizes = s._inside(rows, wanted, []).groupBy(place).count()
    assert sizes.count() > 4000 and sizes.agg(F.max("count")).first()[0] < 60
    assert s.exact_median(df, "v").first().median == pytest.approx(1000 + 99_999.5 * 5e-7, rel=1e-15)
    found = s.narrowed_at_ranks(df, "v", ["g"], lambda n: [F.lit(0), n - 1, F.floor(n / 2)], 3)
    got = {r.g: (r.n, [round((v - 1000) / 5e-7) for v in r.at_ranks]) for r in found.collect()}
    assert got == {0: (100_000, [0, 199_998, 100_000]), 1: (100_000, [1, 199_999, 100_001])}


@pytest.mark.parametrize("name", sorted(CASES))
def test_narrowed_ranks(spark, name):
    values = [float(v) for v in CASES[name]]
    df = spark.createDataFrame([(v, None if i % 3 else "g") for i, v in enumerate(values)] + [(None, "g")],
                               "v double, g string").repartition(5)
    assert s.exact_median(df, "v").first().median == pytest.approx(float(np.median(values)), rel=1e-12)
    found = s.narrowed_at_ranks(df, "v", ["g"], lambda n: [F.lit(0), F.floor(n / 2), n - 1, n + 5], 4)
    for r in found.collect():
        mine = sorted(v for i, v in enumerate(values) if (None if i % 3 else "g") == r.g)
        assert (r.n, list(r.at_ranks)) == (len(mine), [mine[0], mine[len(mine) // 2], mine[-1], None])


def test_narrowed_ranks_of_whole_numbers(spark):
    """The whole range of 64-bit numbers, whose differences do not fit one."""
    values = sorted([-(1 << 63), (1 << 63) - 1, 0, -1, 1] + [random.Random(i).randrange(-(1 << 63), 1 << 63) for i in range(300)])
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    found = s.narrowed_at_ranks(df, "v", [], lambda n: [F.lit(0), F.floor(n / 2), n - 1], 3, s.hash_bucket).first()
    assert list(found.at_ranks) == [values[0], values[len(values) // 2], values[-1]]
