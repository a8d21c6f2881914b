"""Links between members of buckets, without comparing all pairs of a bucket."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from storeloom.llm.common import written
from storeloom.llm.components import components


Confirm = Callable[[DataFrame, DataFrame, str], DataFrame]


#: Of two columns that describe members, and the kind of key they share, whether a link is possible.
Likely = Callable[[str, str, Column], Column]


def bucket_links(keys: DataFrame, nodes: DataFrame, likely: Likely, confirm: Confirm, name: str,
                 meet: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Confirmed links ``(a, b)`` that connect whatever the links inside buckets connect.

    ``keys``: ``key``, its ``kind`` (a byte) and a long ``id``, which may be in
    many buckets; ``nodes``: ``id`` and ``m``, what is known of it.
    ``likely(x, y, kind)`` says of two columns like ``m`` whether a link is
    possible, ``kind`` being the largest of the keys by which the two meet (in
    the second comparison, that of one key); ``confirm(pairs, ids, name)`` returns
    the pairs ``(a, b)`` that are links, ``ids`` being all members of buckets.
    Every member is compared with one of its bucket: the one that meets most
    others in all its buckets, as an original does among its copies. Only
    members of one bucket that are in different components after that are
    compared with each other: all that are ``likely``, or the pairs ``(a, b)`` that
    ``meet`` finds among rows of ``key``, ``kind``, ``head``, ``id``, ``component``
    and ``m``. So no link is lost that would join components.
    """
    # Most keys are alone. Counted over the rows of a key, they are worked out and shuffled once.
    size = F.count(F.lit(1)).over(Window.partitionBy("key"))
    crowd = written(keys.withColumn("size", size).filter("size > 1"), f"{name}-crowd")
    degree = crowd.groupBy("id").agg(F.sum("size").alias("degree"))
    known = written(nodes.join(degree, "id").select("id", "degree", "m"), f"{name}-nodes")
    ids = known.select("id")
    place = F.struct("degree", -F.col("id"))
    heads = written(crowd.join(known.select("id", "degree"), "id").groupBy("key")
                    .agg(F.max_by("id", place).alias("head")), f"{name}-heads")
    pairs = crowd.join(heads, "key").filter("id <> head").groupBy(
        F.least("id", "head").alias("a"), F.greatest("id", "head").alias("b")).agg(F.max("kind").alias("kind"))
    first = written(_likely_pairs(pairs, known, likely), f"{name}-first")
    links = confirm(first, ids, f"{name}-first")

    grouped = components(links, f"{name}-groups")
    apart = crowd.select("key", "kind", "id").join(grouped, "id", "left").select(
        "key", "kind", "id", F.coalesce("component", "id").alias("component"))
    apart = written(apart, f"{name}-placed")
    mixed = (apart.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
             .filter("low < high").select("key"))
    apart = written(apart.join(mixed, "key", "left_semi"), f"{name}-mixed")
    apart = apart.join(known.select("id", "m"), "id")
    if meet:
        rest = meet(written(apart.join(heads, "key"), f"{name}-apart"))
    else:
        apart = written(apart, f"{name}-apart")
        rest = apart.alias("x").join(apart.alias("y"), (F.col("x.key") == F.col("y.key")) & (
            F.col("x.component") < F.col("y.component")) & likely("x.m", "y.m", F.col("x.kind")))
        rest = rest.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
    rest = written(rest.join(first, ["a", "b"], "left_anti"), f"{name}-rest")
    return links.unionByName(confirm(rest, ids, f"{name}-rest"))


def _likely_pairs(pairs: DataFrame, known: DataFrame, likely: Likely) -> DataFrame:
    x = known.select(F.col("id").alias("a"), F.col("m").alias("x"))
    y = known.select(F.col("id").alias("b"), F.col("m").alias("y"))
    return pairs.join(x, "a").join(y, "b").filter(likely("x", "y", F.col("kind"))).select("a", "b")
