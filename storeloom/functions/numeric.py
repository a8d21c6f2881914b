"""Money, ratios and rounding.

Money is ``decimal(18,2)`` in tables. Sums run over whole cents in a
``bigint``: exact, independent of row order, and a long add in generated code
instead of a big-decimal add per row.
"""

from pyspark.sql import Column, functions as F

from storeloom.schemas import MONEY


def cents(column: Column | str) -> Column:
    """Whole cents, exact over the whole range of money.

    Amounts below 10^13 go through a double, whose error times 100 is under half
    a cent there; larger ones through a decimal, which is slower.
    """
    c = F.col(column) if isinstance(column, str) else column
    amount = c.cast("double")
    return F.when(F.abs(amount) < 1e13, F.rint(amount * 100).cast("bigint")).otherwise(
        F.round(c.cast("decimal(38,4)") * 100).try_cast("bigint"))


def from_cents(column: Column) -> Column:
    """Cents as a double; correctly rounded, so equal to the decimal's double."""
    return column / F.lit(100)


def cents_to_money(column: Column) -> Column:
    return (column.cast("decimal(20,0)") / F.lit(100)).cast(MONEY)


def round2(column: Column) -> Column:
    """Two digits, half up on the decimal text (not on the binary value)."""
    return F.round(column.cast("decimal(38,6)"), 2).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Rounded quotient; NULL on a zero denominator."""
    return round2(F.try_divide(numerator.cast("double"), denominator.cast("double")))


def pct_change(current: Column, previous: Column) -> Column:
    """Growth in percent; NULL without a previous value or when it is zero."""
    cur, prev = current.cast("double"), previous.cast("double")
    return round2(F.try_divide(cur - prev, prev) * 100)


def finite_or_null(column: Column) -> Column:
    """NaN and both infinities become NULL."""
    infinite = F.abs(column) == F.lit(float("inf"))
    return F.when(F.isnan(column) | infinite, None).otherwise(column)
