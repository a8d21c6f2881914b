"""A sort-merge range join of points with nested intervals, as one sorted sweep.

Opening an interval puts it on top of the stack of active intervals, and
closing it uncovers the interval around it, which each interval knows
beforehand. So a point needs only the last event before it. The sweep is split
by range; the last event before each range is carried into it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from storeloom.llm.common import written

#: Sorts after every continuation of a prefix, as no UTF-8 text holds it.
END = b"\xff"


def sweep(points: DataFrame, intervals: DataFrame, name: str) -> DataFrame:
    """``points`` with ``top``: the innermost interval around ``key``, or null.

    ``points``: ``key`` binary, ``spread`` (splits rows of one key over tasks)
    and other columns. ``intervals``: ``low``, ``high`` binary, ``top`` and
    ``around``, the interval right around it or null; any two are nested or
    apart. The event table is written once, as its partition numbers must not
    change between the two reads.
    """
    events = intervals.select(F.explode(F.array(
        F.struct(F.col("low").alias("key"), F.struct("top").alias("event")),
        F.struct(F.col("high").alias("key"), F.struct(F.col("around").alias("top")).alias("event")),
    )).alias("e")).select("e.*")
    merged = (points.unionByName(events, allowMissingColumns=True)
              .withColumn("is_point", F.col("event").isNull())
              .repartitionByRange("key", "is_point", "spread")
              .withColumn("part", F.spark_partition_id()))
    merged = written(merged, name)
    # One row per range partition: the last event before it.
    last = (merged.filter(~F.col("is_point")).groupBy("part")
            .agg(F.max_by("event", "key").alias("event")))
    parts = merged.select("part").distinct().join(last, "part", "left")
    before = parts.select("part", F.last("event", ignorenulls=True).over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    seen = F.last("event", ignorenulls=True).over(
        Window.partitionBy("part").orderBy("key", "is_point")
        .rowsBetween(Window.unboundedPreceding, 0))
    return (merged.withColumn("seen", seen).filter("is_point").join(F.broadcast(before), "part")
            .withColumn("top", F.coalesce("seen", "carried")["top"])
            .drop("seen", "carried", "event", "is_point", "part"))
