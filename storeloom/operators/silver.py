"""Cleaned clients and purchases with their exact quality report.

Every row is tagged once with the first check it fails. The clean table keeps
the untagged rows; the report counts the tags. Both come from the same tagged
frame, so they cannot disagree.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from storeloom.functions.numeric import ratio
from storeloom.operators import quality as q
from storeloom.schemas import CLIENT_COLUMNS, MONEY, PURCHASE_COLUMNS

# Survivors among copies are picked on the texts as they came, before trimming.
CLIENT_ORDER = ["subscription_date", "email", "name", "country"]
PURCHASE_ORDER = ["purchase_date", "id_client", "product", "price", "quantity", "total"]

CLIENT_METRICS = ["initial_rows", "null_values", "invalid_dates", "future_dates_fixed",
                  "invalid_emails", "invalid_numbers", "duplicates_removed", "final_rows"]
PURCHASE_METRICS = ["initial_rows", "null_values", "invalid_dates", "future_dates_fixed",
                    "invalid_numbers", "negative_values", "total_recalculated",
                    "orphan_purchases", "duplicates_removed", "final_rows"]


def _first_failure(checks: Sequence[tuple[str, Column]]) -> Column:
    name, failed = checks[0]
    out = F.when(failed, F.lit(name))
    for name, failed in checks[1:]:
        out = out.when(failed, F.lit(name))
    return out


def _null_mask(columns: Sequence[str]) -> Column:
    """One bit per column that is NULL; 0 for a complete row."""
    bits = [F.when(F.col(c).isNull(), 1 << i).otherwise(0) for i, c in enumerate(columns)]
    return reduce(lambda a, b: a + b, bits)


def _read_once(rows: DataFrame, columns: Sequence[Column]) -> DataFrame:
    """``columns``, each computed once for a row.

    As rows of an array they are no expressions that a later filter or join
    condition could take in and repeat.
    """
    return rows.select(F.inline(F.array(F.struct(*columns))))


def tag_clients(bronze: DataFrame, as_of: date) -> DataFrame:
    """Typed clients with ``drop_reason``, ``null_mask`` and ``was_future``."""
    read = _read_once(bronze, [
        _null_mask(CLIENT_COLUMNS).alias("null_mask"),
        q.number("id_client").alias("id_client"), F.col("name"), F.col("email"),
        q.parsed_date("subscription_date").alias("subscription_date"), F.col("country")])
    dated = (F.col("null_mask") == 0) & F.col("subscription_date").isNotNull()
    reason = _first_failure([
        ("null_values", F.col("null_mask") != 0),
        ("invalid_dates", F.col("subscription_date").isNull()),
        ("invalid_emails", ~q.is_email("email")),
        ("invalid_numbers", F.col("id_client").isNull())])
    return read.select(
        "id_client", "name", "email",
        F.least(F.col("subscription_date"), F.lit(as_of)).alias("subscription_date"), "country",
        reason.alias("drop_reason"), "null_mask",
        (dated & (F.col("subscription_date") > F.lit(as_of))).alias("was_future"))


def tag_purchases(bronze: DataFrame, as_of: date, min_quantity: int = 0) -> DataFrame:
    """Typed purchases with ``drop_reason``, ``null_mask``, ``was_future`` and
    ``was_recalculated``.

    Orphans and duplicates need other rows and are not tagged here.
    """
    numbers = ["id_purchase", "id_client", "price", "quantity", "total"]
    read = _read_once(bronze, [
        _null_mask(PURCHASE_COLUMNS).alias("null_mask"), F.col("product"),
        q.parsed_date("purchase_date").alias("purchase_date"),
        *[q.number(c).alias(c) for c in numbers]])
    dated = (F.col("null_mask") == 0) & F.col("purchase_date").isNotNull()
    negative = (F.col("price") < 0) | (F.col("quantity") < min_quantity)
    fresh = q.recalculated_total()
    reason = _first_failure([
        ("null_values", F.col("null_mask") != 0),
        ("invalid_dates", F.col("purchase_date").isNull()),
        ("invalid_numbers", q.any_null(numbers) | fresh.isNull()),
        ("negative_values", negative)])
    return read.select(
        "id_purchase", "id_client", "product", F.col("price").try_cast(MONEY).alias("price"), "quantity",
        F.least(F.col("purchase_date"), F.lit(as_of)).alias("purchase_date"),
        F.when(reason.isNull(), fresh).otherwise(F.col("total")).alias("total"),
        reason.alias("drop_reason"), "null_mask",
        (dated & (F.col("purchase_date") > F.lit(as_of))).alias("was_future"),
        (reason.isNull() & (F.col("total") != fresh)).alias("was_recalculated"))


def clean_clients(bronze: DataFrame, as_of: date) -> DataFrame:
    return clean_tagged_clients(tag_clients(bronze, as_of))


def clean_tagged_clients(tagged: DataFrame) -> DataFrame:
    """The clean table from tagged clients, which a report can read as well."""
    kept = tagged.where(F.col("drop_reason").isNull()).select(*CLIENT_COLUMNS)
    return (q.dedup_by_key(kept, "id_client", CLIENT_ORDER)
            .transform(q.dedup_by_email)
            .transform(lambda d: q.normalize_strings(d, trim=["name", "country"], lower=["email"]))
            .select(*CLIENT_COLUMNS))


def clean_purchases(bronze: DataFrame, valid_ids: DataFrame, as_of: date,
                    min_quantity: int = 0) -> DataFrame:
    return clean_tagged_purchases(tag_purchases(bronze, as_of, min_quantity), valid_ids)


def clean_tagged_purchases(tagged: DataFrame, valid_ids: DataFrame) -> DataFrame:
    """The clean table from tagged purchases, which a report can read as well."""
    kept = tagged.where(F.col("drop_reason").isNull()).select(*PURCHASE_COLUMNS)
    return (q.orphan_semi_join(kept, valid_ids)
            .transform(lambda d: q.dedup_by_key(d, "id_purchase", PURCHASE_ORDER))
            .transform(lambda d: q.normalize_strings(d, trim=["product"]))
            .select(*PURCHASE_COLUMNS))


def _dropped(reason: str) -> Column:
    return F.sum(F.when(F.col("drop_reason") == reason, F.col("rows"))).alias(reason)


def _nulls(columns: Sequence[str]) -> list[Column]:
    """Rows with a NULL per column, from the bits of ``null_mask``."""
    return [F.coalesce(F.sum(F.when(F.col("null_mask").bitwiseAND(1 << i) != 0, F.col("rows"))),
                       F.lit(0)).alias(f"null_{c}") for i, c in enumerate(columns)]


def _zero_for_null(row: DataFrame, metrics: Sequence[str]) -> DataFrame:
    nulls = [c for c in row.columns if c not in metrics]
    return row.select(*[F.coalesce(F.col(m).cast("bigint"), F.lit(0).cast("bigint")).alias(m)
                        for m in metrics], *nulls)


def client_quality_row(bronze: DataFrame, as_of: date) -> DataFrame:
    """One row, one column per metric and per null count, from one scan of bronze.

    Rejected rows share a NULL key and shrink to a few rows per task before
    the first shuffle; the shuffles are those of cleaning itself.
    """
    return tagged_client_quality_row(tag_clients(bronze, as_of))


def tagged_client_quality_row(tagged: DataFrame) -> DataFrame:
    kept = F.col("drop_reason").isNull()
    by_id = (tagged
             .groupBy(F.when(kept, F.col("id_client")).alias("id_client"), "drop_reason", "null_mask")
             .agg(F.count(F.lit(1)).alias("rows"),
                  F.count_if("was_future").alias("future"),
                  F.min(F.when(kept, F.struct("subscription_date", "email"))).alias("first")))
    by_email = (by_id.groupBy(F.col("first.email").alias("email"), "drop_reason", "null_mask")
                .agg(F.sum("rows").alias("rows"), F.sum("future").alias("future")))
    final = F.count("email")
    row = by_email.agg(
        F.sum("rows").alias("initial_rows"),
        _dropped("null_values"), _dropped("invalid_dates"),
        F.sum("future").alias("future_dates_fixed"),
        _dropped("invalid_emails"), _dropped("invalid_numbers"),
        (F.sum(F.when(kept, F.col("rows"))) - final).alias("duplicates_removed"),
        final.alias("final_rows"), *_nulls(CLIENT_COLUMNS))
    return _zero_for_null(row, CLIENT_METRICS)


def purchase_quality_row(bronze: DataFrame, valid_ids: DataFrame, as_of: date,
                         min_quantity: int = 0) -> DataFrame:
    """One row, one column per metric and per null count, from one scan of bronze."""
    return tagged_purchase_quality_row(tag_purchases(bronze, as_of, min_quantity), valid_ids)


def tagged_purchase_quality_row(tagged: DataFrame, valid_ids: DataFrame) -> DataFrame:
    known = valid_ids.select(F.col("id_client").alias("valid_id"), F.lit(True).alias("known"))
    # Rejected rows look for no client; a hash of theirs that is no id spreads them over the tasks.
    ok = F.col("drop_reason").isNull()
    wanted = F.when(ok, F.col("id_client").cast("string")).otherwise(
        F.concat(F.lit("rejected "), F.xxhash64(*tagged.columns).cast("string")))
    tagged = tagged.withColumn("wanted", wanted).join(
        known.withColumn("wanted", F.col("valid_id").cast("string")).drop("valid_id"), "wanted", "left")
    reason = F.when(F.col("drop_reason").isNotNull(), F.col("drop_reason")).when(
        F.col("known").isNull(), F.lit("orphan_purchases"))
    kept = F.col("drop_reason").isNull()
    by_id = (tagged.withColumn("drop_reason", reason)
             .groupBy(F.when(kept, F.col("id_purchase")).alias("id_purchase"),
                      "drop_reason", "null_mask")
             .agg(F.count(F.lit(1)).alias("rows"),
                  F.count_if("was_future").alias("future"),
                  F.count_if("was_recalculated").alias("recalculated")))
    final = F.count("id_purchase")
    row = by_id.agg(
        F.sum("rows").alias("initial_rows"),
        _dropped("null_values"), _dropped("invalid_dates"),
        F.sum("future").alias("future_dates_fixed"),
        _dropped("invalid_numbers"), _dropped("negative_values"),
        F.sum("recalculated").alias("total_recalculated"),
        _dropped("orphan_purchases"),
        (F.sum(F.when(kept, F.col("rows"))) - final).alias("duplicates_removed"),
        final.alias("final_rows"), *_nulls(PURCHASE_COLUMNS))
    return _zero_for_null(row, PURCHASE_METRICS)


def quality_clients(bronze: DataFrame, as_of: date) -> DataFrame:
    """``(metric, value)`` of the client waterfall."""
    return (client_quality_row(bronze, as_of).select(*CLIENT_METRICS)
            .unpivot([], CLIENT_METRICS, "metric", "value"))


def quality_purchases(bronze: DataFrame, valid_ids: DataFrame, as_of: date,
                      min_quantity: int = 0) -> DataFrame:
    return (purchase_quality_row(bronze, valid_ids, as_of, min_quantity).select(*PURCHASE_METRICS)
            .unpivot([], PURCHASE_METRICS, "metric", "value"))


def quality_report(client_row: DataFrame, purchase_row: DataFrame) -> DataFrame:
    """The nested report, one row: a struct per table and the summary.

    Per-column null counts are maps that name only columns with nulls.
    """
    def section(row: DataFrame, metrics: Sequence[str], columns: Sequence[str]) -> Column:
        counts = F.create_map(*[x for c in columns for x in (F.lit(c), F.col(f"null_{c}"))])
        named = F.map_filter(counts, lambda _, n: n > 0).alias("null_values_by_column")
        return row.select(F.struct(*metrics, named)).scalar()

    # Two one-row scalar subqueries, each evaluated once.
    both = client_row.sparkSession.range(1).select(
        section(client_row, CLIENT_METRICS, CLIENT_COLUMNS).alias("clients"),
        section(purchase_row, PURCHASE_METRICS, PURCHASE_COLUMNS).alias("purchases"))
    rows_in = F.col("clients.initial_rows") + F.col("purchases.initial_rows")
    rows_out = F.col("clients.final_rows") + F.col("purchases.final_rows")
    # The score is a percentage rounded last, so scale before rounding.
    return both.withColumn("summary", F.struct(
        rows_in.alias("total_input_rows"), rows_out.alias("total_output_rows"),
        ratio(rows_out * 100, rows_in).alias("data_quality_score")))


REPORT_SECTIONS = {
    "clients": CLIENT_METRICS,
    "purchases": PURCHASE_METRICS,
    "summary": ["total_input_rows", "total_output_rows", "data_quality_score"],
}


def report_rows(report: DataFrame, sections: dict[str, list[str]] | None = None) -> DataFrame:
    """A nested report as ``(section, metric, value)`` rows of doubles."""
    flat = report.select(*[F.col(f"{s}.{m}").cast("double").alias(f"{s}__{m}")
                           for s, metrics in (sections or REPORT_SECTIONS).items()
                           for m in metrics])
    parts = F.split("key", "__")
    return (flat.unpivot([], flat.columns, "key", "value")
            .select(parts[0].alias("section"), parts[1].alias("metric"), "value"))
