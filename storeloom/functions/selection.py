"""Exact order statistics without gathering the values in one task.

``percentile`` and ``median`` merge every distinct value of a group into one
in-memory map on one task. Here the values are first counted, which combines
on the map side and makes a frequent value one row. A monotone bucket function
then narrows the search: the running count over buckets is small by
construction, and only the buckets that hold a wanted rank are ordered inside.
The counts feed both steps; Spark plans their shuffle once and reuses it.

Values that are nearly all different, such as the spend of clients or hashes of
ids, are not counted one by one: ``narrowed_at_ranks`` counts them per bucket on
the map side, splits the bucket of a wanted rank into buckets of its own range,
and again, and orders only what is left.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from storeloom.session import through_table

_STEPS_PER_OCTAVE = 4096
#: Buckets into which the range of a bucket is split, and how often.
_SPLITS, _ROUNDS = 4096, 2


def magnitude_bucket(value: Column) -> Column:
    """Monotone bucket of a number, about 0.02 % of its magnitude wide.

    A double spans some 2100 octaves, money a few dozen, so the number of
    buckets is bounded whatever the number of rows.
    """
    v = value.cast("double")
    return F.floor(F.signum(v) * F.log2(F.abs(v) + 1) * _STEPS_PER_OCTAVE)


def hash_bucket(value: Column) -> Column:
    """Top 16 bits of a 64-bit hash: 65,536 even buckets."""
    return F.shiftright(value, 48)


def value_counts(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """``by`` columns, ``value`` and ``rows``; NULL values are left out."""
    return (df.where(F.col(value).isNotNull())
            .groupBy(*by, F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("rows")))


def values_at_ranks(counts: DataFrame, by: Sequence[str],
                    ranks: Callable[[Column], list[Column]], n_ranks: int,
                    bucket: Callable[[Column], Column] = magnitude_bucket) -> DataFrame:
    """The values at 0-based ranks of each ``by`` group of counted values.

    ``ranks`` maps the group's row count to ``n_ranks`` wanted ranks. Returns
    one row per group: ``by`` columns, ``n`` and an array ``at_ranks``.
    """
    by = list(by)
    keyed = counts.select(*by, "value", "rows", bucket(F.col("value")).alias("bucket"))

    ordered = Window.partitionBy(*by).orderBy("bucket")
    totals = (
        keyed.groupBy(*by, "bucket").agg(F.sum("rows").alias("size"))
        .select(*by, "bucket", "size",
                F.sum("size").over(ordered).alias("stop"),
                F.sum("size").over(Window.partitionBy(*by)).alias("n"))
        .withColumn("start", F.col("stop") - F.col("size"))
        .withColumn("ranks", F.array(*ranks(F.col("n"))))
        .where(F.exists("ranks", lambda r: (r >= F.col("start")) & (r < F.col("stop"))))
    )

    # At most ``n_ranks`` rows per group; Spark broadcasts them if they are few.
    # Null-safe keys keep a NULL group, and add no filter that would make the
    # two readings of the counts differ and lose their common shuffle.
    wanted = totals.select(*[F.col(c).alias(f"group_{i}") for i, c in enumerate(by)],
                           F.col("bucket").alias("in_bucket"), "start", "n", "ranks")
    same = F.col("bucket").eqNullSafe(F.col("in_bucket"))
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"group_{i}"))
    within = Window.partitionBy(*by, "bucket").orderBy("value")
    placed = (
        keyed.join(wanted, same)
        .withColumn("until", F.col("start") + F.sum("rows").over(within))
        .withColumn("since", F.col("until") - F.col("rows"))
    )

    def pick(i: int) -> Column:
        rank = F.element_at("ranks", i + 1)
        hit = (F.col("since") <= rank) & (rank < F.col("until"))
        return F.max(F.when(hit, F.col("value")))

    return placed.groupBy(*by).agg(
        F.max("n").alias("n"), F.array(*[pick(i) for i in range(n_ranks)]).alias("at_ranks"))


def quantiles_of_counts(counts: DataFrame, probabilities: Sequence[float],
                        by: Sequence[str] = ()) -> DataFrame:
    """Linearly interpolated quantiles per group of counted values.

    Returns ``by`` columns and an array ``quantiles`` of doubles in the order
    of ``probabilities``.
    """
    def position(i: int, n: Column) -> Column:
        return (n - 1) * F.lit(float(probabilities[i]))

    def neighbours(n: Column) -> list[Column]:
        return [f(position(i, n)) for i in range(len(probabilities)) for f in (F.floor, F.ceil)]

    found = values_at_ranks(counts, by, neighbours, 2 * len(probabilities))

    def interpolate(i: int) -> Column:
        low = F.element_at("at_ranks", 2 * i + 1).cast("double")
        high = F.element_at("at_ranks", 2 * i + 2).cast("double")
        at = position(i, F.col("n"))
        return low + (high - low) * (at - F.floor(at))

    return found.select(
        *by, F.array(*[interpolate(i) for i in range(len(probabilities))]).alias("quantiles"))


def exact_quantiles(df: DataFrame, value: str, probabilities: Sequence[float],
                    by: Sequence[str] = ()) -> DataFrame:
    return quantiles_of_counts(value_counts(df, value, by), probabilities, by)


def approx_quantiles(df: DataFrame, value: str, probabilities: Sequence[float],
                     by: Sequence[str] = (), accuracy: int = 10_000) -> DataFrame:
    """As :func:`exact_quantiles`, from a mergeable sketch."""
    probs = F.array(*[F.lit(float(p)) for p in probabilities])
    return df.groupBy(*by).agg(
        F.percentile_approx(F.col(value).cast("double"), probs, accuracy).alias("quantiles"))


def _inside(rows: DataFrame, wanted: DataFrame, by: Sequence[str]) -> DataFrame:
    """The rows within an interval of their group, once for each, with the interval as ``x``.

    ``wanted`` has a row for each group and rank. Without groups the intervals
    are one scalar; else they are joined by group.
    """
    intervals = F.collect_list(F.struct("i", "low", "high", "before", "rank", "n"))
    if by:
        held = wanted.groupBy(*[F.col(c).alias(f"_of_{i}") for i, c in enumerate(by)]).agg(intervals.alias("_all"))
        same = F.lit(True)
        for i, c in enumerate(by):
            same = same & F.col(c).eqNullSafe(F.col(f"_of_{i}"))
        rows = rows.join(held, same)
    else:
        rows = rows.withColumn("_all", wanted.agg(intervals).scalar())
    hit = F.filter("_all", lambda x: F.col("value").between(x["low"], x["high"]))
    return rows.select(*by, "value", F.explode(hit).alias("x"))


def narrowed_at_ranks(df: DataFrame, value: str, by: Sequence[str], ranks: Callable[[Column], list[Column]],
                      n_ranks: int, bucket: Callable[[Column], Column] = magnitude_bucket) -> DataFrame:
    """As :func:`values_at_ranks` of a column's values, for values that are nearly all different.

    Each round counts on the map side, at most 4096 buckets for each rank and
    group. Buckets are ranges, so a rank's bucket is known by its smallest and
    largest value. A first bucket spans 2 ** -12 of a double's magnitude or
    2 ** 48 hashes, and each round splits its actual range by 4096, so of doubles
    some 2 ** 16 different ones at most are left to be ordered, wherever the
    values lie. The values are written to a scratch table, which each round reads.
    So are the intervals that a round leaves, a row for each rank and group: Spark
    knows their size before the next round, broadcasts them while they are few
    and shuffles no values for them, and no later reader repeats the rounds.
    """
    by = list(by)
    # Written once, so that the rounds do not compute the values again.
    rows = through_table(df.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("value")), "values")
    ends = [F.count(F.lit(1)).alias("size"), F.min("value").alias("low"), F.max("value").alias("high")]
    counted = rows.groupBy(*by, bucket(F.col("value")).alias("bucket")).agg(*ends)
    upto, whole = Window.partitionBy(*by).orderBy("bucket"), Window.partitionBy(*by)
    places = counted.select(*by, "size", "low", "high", (F.sum("size").over(upto) - F.col("size")).alias("before"),
                            F.sum("size").over(whole).alias("n"))
    wanted = places.select("*", F.posexplode(F.array(*ranks(F.col("n")))).alias("i", "rank"))
    hit = (F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("size"))
    wanted = through_table(wanted.filter(hit).drop("size"), "wanted")
    for _ in range(_ROUNDS):
        low, high = F.col("x.low").cast("double"), F.col("x.high").cast("double")
        at = F.try_divide(F.col("value").cast("double") - low, high - low)
        split = F.coalesce(F.least(F.floor(at * _SPLITS), F.lit(_SPLITS - 1)), F.lit(0)).alias("bucket")
        counted = _inside(rows, wanted, by).groupBy(*by, "x.i", "x.rank", "x.n", "x.before", split).agg(*ends)
        upto = Window.partitionBy(*by, "i").orderBy("bucket")
        wanted = counted.select(*by, "i", "rank", "n", "size", "low", "high",
                                (F.col("before") + F.sum("size").over(upto) - F.col("size")).alias("before")
                                ).filter(hit).drop("size")
        wanted = through_table(wanted, "wanted")
    left = _inside(rows, wanted, by).groupBy(*by, "x.i", "x.rank", "x.n", "x.before", "value").agg(
        F.count(F.lit(1)).alias("size"))
    upto = Window.partitionBy(*by, "i").orderBy("value")
    found = left.select(*by, "i", "rank", "n", "value", "size",
                        (F.col("before") + F.sum("size").over(upto) - F.col("size")).alias("before")).filter(hit)
    return found.groupBy(*by).agg(F.max("n").alias("n"), F.array(*[
        F.max(F.when(F.col("i") == i, F.col("value"))) for i in range(n_ranks)]).alias("at_ranks"))


def exact_median(df: DataFrame, value: str, approx: bool = False) -> DataFrame:
    """One row, one column ``median``; values may all be different."""
    if approx:
        return approx_quantiles(df, value, [0.5]).select(F.element_at("quantiles", 1).alias("median"))

    def middle(n: Column) -> list[Column]:
        return [F.floor((n - 1) / F.lit(2)), F.ceil((n - 1) / F.lit(2))]

    low, high = (F.element_at("at_ranks", i).cast("double") for i in (1, 2))
    return narrowed_at_ranks(df, value, [], middle, 2).select((low + (high - low) * 0.5).alias("median"))


def hash_split(df: DataFrame, key: str, fraction: float, seed: int,
               label: str | None = None) -> DataFrame:
    """Flag exactly ``floor(fraction * n)`` rows of every label as ``is_train``.

    Rows are ordered by a seeded 64-bit hash of ``key`` (a bijection on
    ``bigint`` keys, so without ties); the hash at the wanted rank is the
    cut-off of its label.
    """
    strata = F.lit(0) if label is None else F.col(label)
    hashed = df.withColumn("_u", F.xxhash64(F.col(key), F.lit(seed))).withColumn("_y", strata)

    def last_train(n: Column) -> list[Column]:
        return [F.floor(n * F.lit(fraction)) - 1]

    cut = (narrowed_at_ranks(hashed, "_u", ["_y"], last_train, 1, hash_bucket)
           .select("_y", F.element_at("at_ranks", 1).alias("_cut")))
    # Written, so that every reader of the split only scans the rows beside a row for each label.
    cut = through_table(cut, "cut")
    flagged = F.coalesce(F.col("_u") <= F.col("_cut"), F.lit(False))
    # A NULL label is a label too.
    cut = cut.withColumnRenamed("_y", "_label")
    return (hashed.join(cut, F.col("_y").eqNullSafe(F.col("_label")), "left")
            .withColumn("is_train", flagged).drop("_u", "_y", "_label", "_cut"))


def tiles(df: DataFrame, order: Sequence[str], groups: int, name: str) -> DataFrame:
    """``df`` with ``name``: the number, from 1, of its n-tile in the order of ``order``.

    Exact, without a window over all rows: rows are sorted in range partitions,
    and the row counts of these, one number for each, give the rank of a
    partition's first row. ``order`` should end in a unique column. The sorted
    rows are written once, so that ranks hold.
    """
    ordered = through_table(df.repartitionByRange(*order).sortWithinPartitions(*order)
                            .withColumn("_at", F.monotonically_increasing_id()), "ranked")
    ordered = ordered.withColumn("_part", F.shiftright("_at", 33).cast("int"))
    # One row per range partition.
    sizes = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("first")).collect()
    before, shifts = 0, []
    for row in sorted(sizes):
        shifts.append((row["_part"], before - row["first"]))
        before += row["n"]
    shift = df.sparkSession.createDataFrame(shifts, "_part int, _shift bigint")
    small, larger = divmod(before, groups)
    # The first tiles have one row more than the others.
    rank, edge = F.col("_at") + F.col("_shift"), larger * (small + 1)
    tile = F.when(rank < edge, F.floor(rank / F.lit(small + 1))).otherwise(
        larger + F.floor((rank - edge) / F.lit(max(small, 1)))) + 1
    return ordered.join(shift, "_part").withColumn(name, tile.cast("int")).drop("_at", "_part", "_shift")
