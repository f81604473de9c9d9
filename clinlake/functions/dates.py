"""Date, calendar and numeric helpers shared by marts and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clinlake.functions.columns import yes_no_from_boolean
from clinlake.functions.keys import date_key

# Fixed calendar range of the date dimension.
CALENDAR_START = "1900-01-01"
CALENDAR_END = "2030-12-31"
CALENDAR_GENERATED_DAYS = 47884
# Fiscal year starts in October: October 2001 belongs to fiscal 2002.
FISCAL_START_MONTH = 10


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def hours_crossed(start: str | Column, end: str | Column) -> Column:
    """Number of hour boundaries between two timestamps (10:50 -> 11:10 is 1).

    This is the warehouse's DATEDIFF('hour') semantics, not elapsed hours.
    """
    a = F.date_trunc("HOUR", _c(start))
    b = F.date_trunc("HOUR", _c(end))
    return F.timestamp_diff("HOUR", a, b)


def days_crossed(start: str | Column, end: str | Column) -> Column:
    """Calendar-day difference (midnights crossed)."""
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start)))


def years_crossed(start: str | Column, end: str | Column) -> Column:
    """Year difference by calendar year only (not birthday-aware)."""
    return F.year(_c(end)) - F.year(_c(start))


def fiscal_year(d: str | Column) -> Column:
    d = _c(d)
    return F.when(F.month(d) >= FISCAL_START_MONTH, F.year(d) + 1).otherwise(F.year(d))


def fiscal_quarter(d: str | Column) -> Column:
    """1 for the first three months from the fiscal start, and so on."""
    months = F.pmod(F.month(_c(d)) - F.lit(FISCAL_START_MONTH), F.lit(12))
    return (F.floor(months / 3) + 1).cast("int")


CALENDAR_ATTRIBUTES = {
    "date_key": date_key,
    "calendar_date": lambda d: d,
    "day_of_month": F.dayofmonth,
    "day_of_week": F.dayname,
    "day_of_week_num": lambda d: F.dayofweek(d) - 1,
    "week_of_year": F.weekofyear,
    "iso_week": F.weekofyear,
    "month_num": F.month,
    "month_name": F.monthname,
    "quarter_num": F.quarter,
    "year_num": F.year,
    "fiscal_year": lambda d: fiscal_year(d),
    "fiscal_quarter": lambda d: fiscal_quarter(d),
    "year_month": lambda d: F.date_format(d, "yyyy-MM"),
    "year_quarter": lambda d: F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string")),
    "is_weekend": lambda d: yes_no_from_boolean(F.dayname(d).isin("Sat", "Sun")),
    "is_month_start": lambda d: yes_no_from_boolean(F.dayofmonth(d) == 1),
    "is_month_end": lambda d: yes_no_from_boolean(d == F.last_day(d)),
}


def calendar_attributes(d: str | Column) -> dict[str, Column]:
    """All attributes of the date dimension, as expressions of one date.

    Reports that only need attributes of a fact's own date compute them
    with these expressions instead of joining the calendar table.
    """
    d = _c(d)
    return {name: fn(d) for name, fn in CALENDAR_ATTRIBUTES.items()}


def in_calendar(d: str | Column) -> Column:
    d = _c(d)
    return d.between(F.lit(CALENDAR_START).cast("date"), F.lit(CALENDAR_END).cast("date"))


def calendar_lookup(d: str | Column, name: str) -> Column:
    """Attribute of the calendar row for ``d``; NULL when ``d`` is outside the
    calendar, i.e. exactly what a left join to the date dimension gives."""
    d = _c(d)
    return F.when(in_calendar(d), CALENDAR_ATTRIBUTES[name](d))


def round2(c: Column, scale: int = 2) -> Column:
    """Half-up rounding of a double, done once on its decimal text.

    Rounding a double directly is engine dependent at exact halves (2.005 is
    2.00499... in binary); the decimal rounds the value the user sees.  A
    double too large for the decimal has no fraction to round, and NaN stays.
    """
    return F.coalesce(F.round(c.try_cast("decimal(38,18)"), scale).cast("double"), c)


MONEY = "decimal(28,10)"
WIDE = "decimal(38,18)"


def money_sum(c: str | Column, kind: str = MONEY) -> Column:
    """Order-independent sum of money held as double.

    Summing doubles depends on the order rows arrive in, which differs
    between runs and partitionings; summing fixed-point decimals does not.
    Money has at most ten decimals here and values below 10^18 (the range of
    decimal(28,10)); a NaN or larger value makes the sum fall back to doubles.
    """
    c = _c(c)
    exact = c.try_cast(kind)
    lost = F.count(F.when(c.isNotNull() & exact.isNull(), F.lit(1)))
    return F.when(lost == 0, F.sum(exact).cast("double")).otherwise(F.sum(c))


def money_avg(c: str | Column) -> Column:
    c = _c(c)
    return money_sum(c) / F.nullif(F.count(c), F.lit(0))


def exact_sum(c: str | Column) -> Column:
    """Sum of money as a decimal, for sums that are combined further (values beyond it are an error)."""
    return F.sum(_c(c).cast(MONEY))
