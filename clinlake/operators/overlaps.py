"""Number of overlapping pairs of closed date ranges, counted by a sweep over their ends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def overlap_count(ranges: DataFrame, key: str, start: str, end: str, number: str) -> DataFrame:
    """One row with ``pairs``: pairs of ranges of a key, where the one with the smaller ``number`` ends on or after
    the day the other one starts.

    ``number`` counts a key's ranges from 1 in the order of their starts (NULL starts last).  No pair is formed.
    Of the n (n - 1) / 2 pairs of a key all overlap but those whose earlier range

    * ends before it starts (such a range reaches no later one): n - number pairs each, or
    * ends before the later one starts: for each start, the ends on earlier days.

    The latter are prefix counts on two levels: starts and ends are first counted per (key, day), which leaves at
    most a few hundred rows of a key and year; ends before a day are those of earlier years (a running sum over the
    years of a key) and of earlier days of the year (a running sum within it).  Neither window holds a key's ranges.
    Ranges without a start take part in no pair; those without an end only as the later one.
    """
    known = ranges.filter(F.col(start).isNotNull()).select(
        F.col(key).alias("k"), F.col(start).alias("a"), F.col(end).alias("b"), F.col(number).cast("bigint").alias("i"))
    reaches = F.coalesce(F.col("b") >= F.col("a"), F.lit(False))
    exact = lambda c: c.cast("decimal(38,0)")
    per_key = known.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.count_if(~reaches).alias("short"),
                                     F.sum(F.when(~reaches, F.col("i")).otherwise(0)).alias("short_numbers"))
    n = exact(F.col("n"))
    possible = per_key.agg(F.sum((n * (n - 1)) / 2 - n * F.col("short") + F.col("short_numbers")).alias("p")).select(
        F.coalesce(F.col("p"), F.lit(0)).cast("decimal(38,0)").alias("x"))

    events = known.select("k", F.explode(F.array(F.struct(F.col("a").alias("day"), F.lit(1).alias("starts"), F.lit(0).alias("ends")),
                                                 F.struct(F.when(reaches, F.col("b")).alias("day"), F.lit(0).alias("starts"), F.lit(1).alias("ends")))).alias("e"))
    days = (events.select("k", "e.*").filter(F.col("day").isNotNull()).groupBy("k", "day")
            .agg(F.sum("starts").alias("starts"), F.sum("ends").alias("ends")).withColumn("y", F.year("day")))
    seen = Window.unboundedPreceding
    none = F.lit(0).cast("bigint")

    def before(c: Column, *by: str, order: str) -> Column:
        return F.coalesce(F.sum(c).over(Window.partitionBy(*by).orderBy(order).rowsBetween(seen, -1)), none)

    in_year = days.withColumn("ended_in", before(F.col("ends"), "k", "y", order="day"))
    years = (days.groupBy("k", "y").agg(F.sum("ends").alias("ends"))
             .select(F.col("k").alias("yk"), F.col("y").alias("yy"), before(F.col("ends"), "k", order="y").alias("ended_before")))
    apart = (in_year.filter("starts > 0").join(years, F.col("k").eqNullSafe(F.col("yk")) & (F.col("y") == F.col("yy")))
             .agg(F.sum(exact(F.col("starts")) * (F.col("ended_in") + F.col("ended_before"))).alias("p"))
             .select((-F.coalesce(F.col("p"), F.lit(0))).cast("decimal(38,0)").alias("x")))
    return possible.unionAll(apart).agg(F.sum("x").cast("bigint").alias("pairs"))
