"""Point-in-time join against a type-2 (validity range) dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinlake.operators.ranking import top1


def period_segments(periods: DataFrame, key: str, valid_from: str, valid_to: str, latest: Sequence[tuple]) -> DataFrame:
    """Disjoint elementary segments of each entity's periods, each with the period that wins on its days.

    Columns of ``periods``, with ``_seg_y`` and ``_seg_from`` (the segment's year and first day).  A segment without
    a valid period has NULL period columns, so a look-up backwards from any day needs one row only.  Periods are
    first cut at year ends, so all work is by (entity, year): segments begin where a period begins or the day after
    one ends, and the winner of each is a partially aggregated top-1 of the periods that cover it."""
    cols = periods.columns
    known = periods.filter(F.col(key).isNotNull() & (F.col(valid_from) <= F.col(valid_to)))
    cut = (known.withColumn("_seg_y", F.explode(F.sequence(F.year(valid_from), F.year(valid_to))))
           .withColumn("_in", F.greatest(F.col(valid_from), F.make_date("_seg_y", F.lit(1), F.lit(1))))
           .withColumn("_out", F.least(F.col(valid_to), F.make_date("_seg_y", F.lit(12), F.lit(31)))))
    begins = (cut.select(F.col(key).alias("_sk"), F.col("_seg_y").alias("_sy"),
                         F.explode(F.array("_in", F.when(F.year(F.date_add("_out", 1)) == F.col("_seg_y"), F.date_add("_out", 1)))).alias("_seg_from"))
              .filter(F.col("_seg_from").isNotNull()).groupBy("_sk", "_sy", "_seg_from").agg(F.count(F.lit(1)).alias("_n")).drop("_n"))
    covering = begins.join(cut, (F.col("_sk") == F.col(key)) & (F.col("_sy") == F.col("_seg_y"))
                           & F.col("_seg_from").between(F.col("_in"), F.col("_out")), "left")
    return top1(covering.select("_sk", "_sy", "_seg_from", *cols), ["_sk", "_sy", "_seg_from"], list(latest))


def point_in_time_join(events: DataFrame, periods: DataFrame, key: str, event_date: Column,
                       valid_from: str, valid_to: str, latest: Sequence[tuple], prefix: str = "pit_") -> DataFrame:
    """Attach to every event the latest period valid on its date, for periods of any dates.

    Left join on ``key`` with ``event_date BETWEEN valid_from AND valid_to`` (closed range), of which each event
    keeps the first period by ``latest`` (period columns, e.g. ``[("effective_from","desc","first"),
    ("scd2_version","desc","first")]``).  Events keep their rows; those without a valid period have NULL period
    columns, which come back prefixed with ``prefix``.

    Plan: the periods become disjoint segments (:func:`period_segments`).  The distinct (entity, day) pairs of the
    events look backwards for the segment of their day, in a window by (entity, year) that holds a segment or a day
    at most once for each day of the year.  The events then meet their day's answer in an equi-join on
    (entity, day) with one match at most: an event never meets several periods, repeated rows are never ranked, and
    an entity with a third of all events is spread over its days.
    """
    d = "_pit_event_date"
    ev = events.withColumn(d, event_date)
    segments = period_segments(periods, key, valid_from, valid_to, latest)
    found = F.struct(*[F.col(c) for c in periods.columns])
    nothing = F.lit(None).cast(segments.select(found.alias("p")).schema["p"].dataType)
    days = (ev.filter(F.col(key).isNotNull() & F.col(d).isNotNull()).groupBy(F.col(key).alias("_sk"), F.col(d).alias("_day"))
            .agg(F.count(F.lit(1)).alias("_n"))
            .select("_sk", F.year("_day").alias("_sy"), "_day", F.lit(1).alias("_kind"), nothing.alias("_p")))
    starts = segments.select("_sk", "_sy", F.col("_seg_from").alias("_day"), F.lit(0).alias("_kind"), found.alias("_p"))
    back = Window.partitionBy("_sk", "_sy").orderBy("_day", "_kind")
    at = F.last(F.when(F.col("_kind") == 0, F.col("_p")), ignorenulls=True).over(back)
    answers = (starts.unionAll(days).withColumn("_p", at).filter("_kind = 1")
               .select("_sk", "_day", *[F.col(f"_p.{c}").alias(prefix + c) for c in periods.columns]))
    return ev.join(answers, (ev[key] == answers["_sk"]) & (ev[d] == answers["_day"]), "left").drop("_sk", "_day", d)


def join_period_of_year(events: DataFrame, periods: DataFrame, key: str, event_date: Column, valid_from: str,
                        valid_to: str, latest: Sequence[tuple], prefix: str = "pit_") -> DataFrame:
    """Point-in-time join for periods of whole calendar years (Jan 1 .. Dec 31).

    All dates of a year then have the same valid periods, so the winning one
    is picked per (entity, year) on the small period side, by a partially
    aggregated top-1, and the events meet it in a plain equi-join with at most
    one match: they are not ranked and keep their rows.  An entity with very
    many events is spread over its years; what stays hot is a skewed equi-join
    that adaptive execution splits.
    """
    year = "_pit_y"
    p = periods.select([F.col(c).alias(prefix + c) for c in periods.columns]).withColumn(
        year, F.explode(F.sequence(F.year(prefix + valid_from), F.year(prefix + valid_to))))
    winner = top1(p, [prefix + key, year], [(prefix + c, *rest) for c, *rest in latest])
    ev = events.withColumn("_pit_ey", F.year(event_date))
    return ev.join(winner, (ev[key] == winner[prefix + key]) & (ev["_pit_ey"] == winner[year]), "left").drop("_pit_ey", year)
