"""Calendar attributes and period keys of a DATE column."""

from pyspark.sql import Column, functions as F

# English day names, Monday first.
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def week_start(day: Column) -> Column:
    return F.trunc(day, "week")


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def year_month(day: Column) -> Column:
    return F.substring(iso_date(day), 1, 7)


def day_name(day: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in DAY_NAMES]), F.weekday(day) + 1)


def year_week(day: Column, style: str = "iso") -> Column:
    """Label of the Monday-first week.

    ``iso`` gives ``2025-W01``; the year is that of the week's Thursday, so
    labels sort in time order across a year end. ``range`` gives the first
    and last day, ``2024-12-30/2025-01-05``.
    """
    if style == "range":
        monday = week_start(day)
        return F.concat_ws("/", iso_date(monday), iso_date(F.date_add(monday, 6)))
    if style != "iso":
        raise ValueError(f"unknown week label style {style!r}")
    week = F.weekofyear(day)
    mark = F.when(week < 10, "-W0").otherwise("-W")
    year = F.extract(F.lit("YEAROFWEEK"), day)
    return F.concat(year.cast("string"), mark, week.cast("string"))


def iso_date(day: Column) -> Column:
    """``yyyy-MM-dd``; the cast is much cheaper than a format pattern."""
    return day.cast("string")


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)
