"""Dense time series: every period of the calendar for every observed group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.functions.dates import CALENDAR_END, CALENDAR_START

STEPS = {"day": "interval 1 day", "week": "interval 7 days", "month": "interval 1 month", "quarter": "interval 3 months", "year": "interval 1 year"}


def dense_series(df: DataFrame, period: str, groups: Sequence[str], grain: str) -> DataFrame:
    """``df`` (one row per period and group) with a row for every period between the first and the last one.

    The first and last period are one scalar subquery, kept inside the calendar; every distinct group explodes its own
    spine from them (as long as the calendar at most), and meets its rows in one NULL-safe equi-join, so nothing is
    joined pairwise.  Rows without a period, or with one outside the calendar, are kept as they are; other columns
    of a period that a group lacks are NULL."""
    known = df.filter(F.col(period).between(F.lit(CALENDAR_START).cast("date"), F.lit(CALENDAR_END).cast("date")))
    range_ = known.agg(F.struct(F.min(period).alias("first"), F.max(period).alias("last")).alias("range")).scalar()
    first, last = range_["first"], range_["last"]
    spine = F.explode(F.sequence(first, last, F.expr(STEPS[grain]))).alias("_period")
    if groups:
        keys = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n")).select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)])
    else:
        keys = df.sparkSession.range(1).select()
    keys = keys.filter(first.isNotNull())
    series = keys.select("*", spine)
    own = df.select([F.col(c).alias(f"_d_{c}") for c in df.columns])
    on = F.col("_period").eqNullSafe(F.col(f"_d_{period}"))
    for i, g in enumerate(groups):
        on = on & F.col(f"_g{i}").eqNullSafe(F.col(f"_d_{g}"))
    joined = series.join(own, on, "full_outer")
    place = {g: F.when(F.col("_period").isNotNull(), F.col(f"_g{i}")).otherwise(F.col(f"_d_{g}")) for i, g in enumerate(groups)}
    place[period] = F.coalesce(F.col("_period"), F.col(f"_d_{period}"))
    return joined.select(*[place.get(c, F.col(f"_d_{c}")).alias(c) for c in df.columns])
