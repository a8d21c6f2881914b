"""URL filters by a sort-merge range join over reversed-host keys.

``com.example.`` is the key of the host ``example.com``. Every host below it
has a key with that prefix, so a rule's host is an interval of keys, and a
rule's path is an interval of the paths on that host. Two sorted sweeps merge
the pages into these nested intervals: the first finds the innermost host that
has rules, the second the innermost path rule of that host and of each host
around it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from storeloom.llm.common import written
from storeloom.llm.intervals import END, sweep

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """``(host, path)``; both empty for a null url and one without ``://``."""
    at = F.instr(url, "://")
    after = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    raw = F.regexp_extract(after, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(after, F.length(raw) + 1), "^[^?#]*", 0)
    return (F.coalesce(F.translate(raw, UPPER, LOWER), F.lit("")),
            F.coalesce(path, F.lit("")))


def _labels(host: Column) -> Column:
    return F.split(host, "\\.", -1)


def _key(host: Column) -> Column:
    """Labels from the last to the first, each ended by a dot."""
    return F.concat(F.array_join(F.reverse(_labels(host)), "."), F.lit(".")).cast("binary")


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """``(verdict, host, path)`` rows as the frame that ``judge`` takes."""
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def _host_intervals(hosts: DataFrame) -> DataFrame:
    """Intervals of the hosts that have rules, each with the chain of such hosts down to it."""
    size = F.size(_labels(F.col("host")))
    suffixes = hosts.select("host", F.explode(F.sequence(F.lit(1), size)).alias("i")).select(
        "host", F.array_join(F.slice(_labels(F.col("host")), F.col("i"), size), ".").alias("outer"))
    chains = (suffixes.join(hosts.select(F.col("host").alias("outer")), "outer")
              .groupBy("host").agg(F.collect_list("outer").alias("chain")))
    around = F.filter("chain", lambda h: h != F.col("host"))
    key = _key(F.col("host"))
    return chains.select(key.alias("low"), F.concat(key, F.lit(END)).alias("high"), F.col("chain").alias("top"),
                         F.when(F.size(around) > 0, around).alias("around"))


def _path_key(host: Column, path: Column) -> Column:
    return F.concat(host, F.lit("\0"), path).cast("binary")


def _path_intervals(rules: DataFrame) -> DataFrame:
    """Intervals of the rules; ``around`` is the next shorter path rule of the same host."""
    shorter = (rules.filter(F.length("path") > 0)
               .select("host", "path", F.explode(F.sequence(F.lit(0), F.length("path") - 1)).alias("i"))
               .select("host", "path", F.substr("path", F.lit(1), F.col("i")).alias("outer"))
               .join(rules.select("host", F.col("path").alias("outer"), F.col("verdict").alias("found")),
                     ["host", "outer"])
               .groupBy("host", "path")
               .agg(F.max_by(F.struct(F.col("outer").alias("path"), F.col("found").alias("verdict")),
                             F.length("outer")).alias("around")))
    key = _path_key(F.col("host"), F.col("path"))
    return rules.join(shorter, ["host", "path"], "left").select(
        key.alias("low"), F.concat(key, F.lit(END)).alias("high"), F.struct("path", "verdict").alias("top"), "around")


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """``pages`` without ``url``, with ``host``, ``path``, ``rule`` and ``verdict``.

    A rule fits its host and all subdomains if the path starts with the rule's.
    The longest rule (host and path together) wins; of equally long ones that
    with the longer host. Repeated rules count once, and the verdict that sorts
    last wins (``block`` over ``allow``). Rules with a null or empty host or a
    null path fit nothing. Urls no rule fits get ``default`` and a null rule.
    Repeated pages stay; columns of the result's names are replaced.
    """
    rules = (rules.select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict")
             .filter("host <> '' AND path IS NOT NULL")
             .groupBy("host", "path").agg(F.max("verdict").alias("verdict")))
    host, path = url_parts(F.col(url))
    others = [c for c in pages.columns if c not in (url, "host", "path", "rule", "verdict")]
    rows = pages.select(F.struct(*others).alias("page") if others else F.lit(0).alias("page"),
                        host.alias("page_host"), path.alias("page_path"))
    rows = rows.withColumn("row", F.monotonically_increasing_id()).withColumn(
        "key", _key(F.col("page_host"))).withColumn("spread", F.xxhash64("page_path", "row"))
    hosts = _host_intervals(rules.select("host").distinct())
    inner = written(sweep(rows, hosts, "hosts").drop("key", "spread"), "pages")
    points = inner.select("row", "page_path", F.explode("top").alias("host"))
    points = points.withColumn("key", _path_key(F.col("host"), F.col("page_path"))).withColumn(
        "spread", F.xxhash64("row"))
    fits = sweep(points, _path_intervals(rules), "paths").filter("top IS NOT NULL")
    rank = F.struct(F.length("host") + F.length("top.path"), F.length("host"))
    best = (fits.groupBy("row").agg(F.max_by(F.struct(F.concat("host", "top.path").alias("rule"),
                                                      F.col("top.verdict").alias("found")), rank)
                                    .alias("best")).select("row", "best.*"))
    kept = [F.col("page")[c].alias(c) for c in others]
    return inner.join(best, "row", "left").select(
        *kept, F.col("page_host").alias("host"), F.col("page_path").alias("path"), "rule",
        F.coalesce("found", F.lit(default)).alias("verdict"))
