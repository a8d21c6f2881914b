"""Full refresh of the serving tables from gold."""

from __future__ import annotations

import logging
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from storeloom.layout import Layout
from storeloom.operators.serving import nan_to_null
from storeloom.plans.parallel import run_together
from storeloom.schemas import GOLD_TABLES
from storeloom.sources import sinks

log = logging.getLogger(__name__)

# How each serving table is ordered. Range partitions on these keys give
# Parquet min/max statistics that answer key lookups. The fact's key ends in
# the purchase id, so the rows of a client with very many purchases spread
# over several partitions.
ORDER = {
    "fact_sales": ["id_client", "id_purchase"],
    "client_kpis": ["id_client"],
    "product_analytics": ["product"],
    "country_analytics": ["country"],
    "daily_sales": ["date"],
    "weekly_sales": ["week_start"],
    "monthly_sales": ["month_start"],
}
# Lookup keys outside the order's first column get bloom filters.
LOOKUP_KEYS = ["id_client", "id_purchase", "date", "product", "country"]

_LOG = "finished timestamp, snapshot string, rows bigint"


def _finished(spark: SparkSession, base: str) -> list[str]:
    """Paths of the complete snapshots of a serving table, oldest first.

    A snapshot is complete when the log names it; the log is a small Parquet
    table to which a refresh appends one row after its data is written.
    """
    try:
        log_rows = spark.read.schema(_LOG).parquet(f"{base}/log").orderBy("finished", "snapshot").collect()
    except AnalysisException:
        return []
    return [f"{base}/{row.snapshot}" for row in log_rows]


def read_serving(spark: SparkSession, layout: Layout, table: str) -> DataFrame:
    """The newest complete snapshot of a serving table."""
    complete = _finished(spark, layout.path("serving", table))
    if not complete:
        raise FileNotFoundError(f"no serving snapshot of {table}")
    return spark.read.parquet(complete[-1])


def load_table(spark: SparkSession, layout: Layout, table: str, keep: int = 2) -> int:
    """Write a new snapshot of one table and return its row count.

    Readers take the newest complete snapshot, so they see the old data until
    the write ends, and keep it if the write fails. Every snapshot has a name
    of its own, so two refreshes never share one. Of the complete snapshots the
    newest ``keep`` stay; older ones are emptied, unfinished ones count for
    nothing.
    """
    if table not in ORDER:
        raise ValueError(f"no serving table {table}")
    keys = ORDER[table]
    source = nan_to_null(spark.read.parquet(layout.path("gold", table)))
    base = layout.path("serving", table)
    name = f"snapshot-{uuid.uuid4().hex}"
    blooms = [c for c in LOOKUP_KEYS if c in source.columns and c != keys[0]]
    sinks.write_parquet(source.repartitionByRange(*keys).sortWithinPartitions(*keys),
                        f"{base}/{name}", bloom_columns=blooms)
    rows = spark.read.parquet(f"{base}/{name}").count()
    entry = spark.range(1).select(F.current_timestamp().alias("finished"), F.lit(name).alias("snapshot"),
                                  F.lit(rows).cast("bigint").alias("rows"))
    entry.write.mode("append").parquet(f"{base}/log")
    for old in _finished(spark, base)[:-keep][-keep:]:
        spark.createDataFrame([], source.schema).write.mode("overwrite").parquet(old)
    return rows


def refresh_serving(spark: SparkSession, layout: Layout,
                    tables: list[str] | None = None) -> DataFrame:
    """Refresh all serving tables: ``table``, ``status``, ``rows``, ``seconds``, ``error``.

    A table that fails is logged, keeps its old data and has the status
    ``failed``; the others go on.
    """
    def load(table: str) -> tuple[str, str, int | None, float, str | None]:
        start = time.perf_counter()
        try:
            rows, status, error = load_table(spark, layout, table), "loaded", None
        except Exception as failure:
            log.exception("refresh of %s failed", table)
            rows, status, error = None, "failed", str(failure).splitlines()[0]
        return table, status, rows, round(time.perf_counter() - start, 3), error

    wanted = GOLD_TABLES if tables is None else tables
    done = run_together(spark, [lambda t=t: load(t) for t in wanted])
    return spark.createDataFrame(done, "table string, status string, rows bigint, seconds double, error string")
