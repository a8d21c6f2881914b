"""Silver building blocks: predicates, repairs, deduplication and integrity."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from storeloom.functions.calendar import iso_date
from storeloom.schemas import MONEY, PRICE

# The accepted e-mail form and the characters that count as
# blank around a text. The end anchor allows one final newline, which
# trimming then removes.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\n?\z"
BLANKS = (" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
          "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")

# Texts of a source file that stand for a missing value.
NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
               "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

NUMERIC_TYPES = {"id_purchase": "bigint", "id_client": "bigint", "price": PRICE,
                 "quantity": "bigint", "total": MONEY}
# Fixed value: the only form in which a date is read.
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"


# --- expressions -----------------------------------------------------------

def any_null(columns: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def parsed_date(column: str) -> Column:
    """The date, or NULL for text that is none (plain ``to_date`` would raise).

    The whole text, blanks at its ends aside, must be ``yyyy-MM-dd``: years,
    months and dates with a tail are no dates.
    """
    text = trimmed(column)
    return F.when(text.rlike(DATE_PATTERN), F.try_to_date(text))


def is_email(column: str) -> Column:
    return F.coalesce(F.col(column).rlike(EMAIL_PATTERN), F.lit(False))


def trimmed(column: str) -> Column:
    """The text without blanks at its ends.

    Every blank lies outside the printable ASCII range, so a look at the end
    characters spares nearly all texts the slower general trim.
    """
    c = F.col(column)
    ends = [F.ascii(c), F.ascii(F.substring(c, -1, 1))]
    plain = reduce(lambda a, b: a & b, [e.between(33, 126) for e in ends])
    return F.when(plain, c).otherwise(F.trim(c, F.lit(BLANKS)))


def number(column: str) -> Column:
    """The column as its silver number type, NULL when it is no number.

    Whole-number columns, ids included, go through a decimal, so that ``2.0``
    is read as 2; with a fraction, as in ``2.9``, a value is no whole number and
    is never cut to one. A price keeps its digits until it is multiplied.
    """
    kind = NUMERIC_TYPES[column]
    if kind == "bigint":
        exact = F.col(column).cast("string").try_cast("decimal(38,18)")
        return F.coalesce(F.col(column).cast("string").try_cast("bigint"),
                          F.when(exact == F.floor(exact), exact.try_cast("bigint")))
    return F.col(column).try_cast(kind)


# --- operators -------------------------------------------------------------

def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
                    rank_column: str = "rank") -> DataFrame:
    """The first ``k`` rows of every group; ``order`` should end in a unique column.

    Spark limits each group before the shuffle as well as after it, so a
    large group reaches its task with at most ``k`` rows per input task.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return (df.withColumn(rank_column, F.row_number().over(window))
            .where(F.col(rank_column) <= k))


def tokens_to_null(df: DataFrame, tokens: Sequence[str] = tuple(NULL_TOKENS)) -> DataFrame:
    """Texts that stand for a missing value become NULL in all text columns."""
    if not tokens:
        return df
    texts = [n for n, t in df.dtypes if t == "string"]
    return df.withColumns({n: F.when(~F.col(n).isin(*tokens), F.col(n)) for n in texts})


def profile_nulls(df: DataFrame) -> DataFrame:
    """``(column, null_count)`` of the columns that have nulls, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = counts.unpivot([], df.columns, "column", "null_count")
    return long.where(F.col("null_count") > 0)


def drop_null_rows(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def parse_dates(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, parsed_date(column)).where(F.col(column).isNotNull())


def cap_future_dates(df: DataFrame, column: str, as_of: date) -> DataFrame:
    return df.withColumn(column, F.least(F.col(column), F.lit(as_of)))


def format_dates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Dates as ``yyyy-MM-dd`` text, for text formats; all date columns by default."""
    names = columns or [n for n, t in df.dtypes if t == "date"]
    return df.withColumns({n: iso_date(F.col(n)) for n in names}) if names else df


def validate_email(df: DataFrame, column: str = "email") -> DataFrame:
    """Keep valid addresses; padding makes an address invalid."""
    return df.where(is_email(column))


def dedup_by_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key, the least by ``order``.

    ``order`` lists the other columns, so the survivor does not depend on the
    order of the input. Spark applies the limit of one per key before the
    shuffle as well: the copies of a frequent key shrink to one row per task.
    """
    return top_k_per_group(df, [key], [F.col(c) for c in order], 1, "_rank").drop("_rank")


def dedup_by_email(df: DataFrame) -> DataFrame:
    return dedup_by_key(df, "email", ["id_client", "subscription_date", "name", "country"])


def normalize_strings(df: DataFrame, trim: Sequence[str] = (),
                      lower: Sequence[str] = ()) -> DataFrame:
    changes = {c: trimmed(c) for c in trim}
    changes |= {c: F.lower(trimmed(c)) for c in lower}
    return df.withColumns(changes)


def coerce_numeric(df: DataFrame) -> DataFrame:
    """Numbers from text; rows with text that is no number are dropped, as are fractions of whole numbers."""
    present = [c for c in NUMERIC_TYPES if c in df.columns]
    return df.withColumns({c: number(c) for c in present}).na.drop("any", subset=present)


def reject_negative(df: DataFrame, min_quantity: int = 0) -> DataFrame:
    return df.where((F.col("price") >= 0) & (F.col("quantity") >= min_quantity))


def recalculated_total() -> Column:
    """Price times quantity, rounded once; NULL beyond the range of money."""
    return F.try_multiply(F.col("price"), F.col("quantity").cast("decimal(19,0)")).try_cast(MONEY)


def recalc_total(df: DataFrame) -> DataFrame:
    """``total`` from price and quantity; ``total_recalculated`` marks repairs."""
    fresh = recalculated_total()
    return df.select(*[c for c in df.columns if c != "total"], fresh.alias("total"),
                     (F.col("total") != fresh).alias("total_recalculated"))


def orphan_semi_join(purchases: DataFrame, valid_ids: DataFrame) -> DataFrame:
    return purchases.join(valid_ids.select("id_client"), "id_client", "left_semi")


def orphan_rejects(purchases: DataFrame, valid_ids: DataFrame) -> DataFrame:
    return purchases.join(valid_ids.select("id_client"), "id_client", "left_anti")
