"""First following event: a forward as-of self-join without the quadratic join.

For every *anchor* (e.g. an inpatient discharge at time ``t``) find the
earliest *candidate* (e.g. any encounter) of the same entity that starts
strictly after ``t``; ties on time go to the smallest tie-break value.

The naive form joins anchors to candidates on the entity with ``start > t``
and ranks the pairs: quadratic per entity.  Here:

1. Candidates collapse to one row per (entity, instant), the minimum
   candidate at that instant; anchors collapse to their distinct
   (entity, instant).  Both are partial aggregations, so copies of one
   event (however many) become one row per map task before any shuffle.
2. The timeline is cut into buckets (an hour by default).  Inside a bucket,
   instants are sorted descending and ``min(candidate)`` over the instants
   already seen is the first candidate strictly later in the same bucket.
3. Across buckets, one minimum per (entity, bucket), read from step 2's
   partitioning (an unordered window on the same partition, no shuffle), and
   a window over each entity's buckets sorted descending gives the minimum
   of all later buckets.
4. The answer for an instant is (2) when present, else (3); anchors get it
   back by an equi-join on (entity, instant).

Window partitions hold distinct instants of one entity-bucket (2) and the
distinct buckets of one entity, bounded by the calendar (3); both use
growing frames (``unbounded preceding .. 1 preceding``), linear in rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_following(anchors: DataFrame, candidates: DataFrame, key: str, anchor_time: str,
                    candidate_time: str, tie_break: Sequence[str], payload: Sequence[str],
                    bucket: str = "HOUR", match: str = "match") -> DataFrame:
    """Anchors with a struct column ``match`` = (time, *tie_break, *payload) of
    the first candidate strictly after the anchor time, or NULL.

    At one instant the tie-break values ascend with NULLs last, as in an
    ascending ORDER BY of the source: each is led by its null flag in the struct."""
    ties = [x for c in tie_break for x in (F.col(c).isNull().alias(f"_null_{c}"), F.col(c))]
    cand_struct = F.struct(F.col(candidate_time).alias("time"), *ties, *[F.col(c) for c in payload])
    cand = (candidates.filter(F.col(key).isNotNull() & F.col(candidate_time).isNotNull())
            .select(F.col(key).alias("_k"), F.col(candidate_time).alias("_t"), cand_struct.alias("_c"),
                    F.lit(False).alias("_anchor")))
    c_type = cand.schema["_c"].dataType
    anc = (anchors.filter(F.col(key).isNotNull() & F.col(anchor_time).isNotNull())
           .select(F.col(key).alias("_k"), F.col(anchor_time).alias("_t"), F.lit(None).cast(c_type).alias("_c"),
                   F.lit(True).alias("_anchor")))

    # one row per (entity, instant), partially aggregated: copies of a
    # candidate or of an anchor collapse map-side, before the shuffle
    instants = (cand.unionByName(anc)
                .groupBy("_k", "_t").agg(F.min("_c").alias("_c"), F.max("_anchor").alias("_anchor"))
                .withColumn("_b", F.date_trunc(bucket, F.col("_t"))))

    seen = Window.unboundedPreceding
    in_bucket_w = Window.partitionBy("_k", "_b").orderBy(F.col("_t").desc()).rowsBetween(seen, -1)
    whole_bucket = Window.partitionBy("_k", "_b")
    # both windows share one (entity, bucket) partitioning and sort; the
    # bucket minimum is read from it, so the instants are computed once
    in_bucket = (instants.withColumn("_in", F.min("_c").over(in_bucket_w))
                 .withColumn("_bmin", F.min("_c").over(whole_bucket)))

    later_w = Window.partitionBy("_k").orderBy(F.col("_b").desc()).rowsBetween(seen, -1)
    buckets = (in_bucket.groupBy("_k", "_b")
               .agg(F.max("_bmin").alias("_bmin"), F.max("_anchor").alias("_has_anchor"))
               .withColumn("_next", F.min("_bmin").over(later_w))
               .filter("_has_anchor")
               .select("_k", "_b", "_next"))

    answers = (in_bucket.filter("_anchor")
               .join(buckets, ["_k", "_b"], "left")
               .select(F.col("_k").alias("_ak"), F.col("_t").alias("_at"),
                       F.coalesce("_in", "_next").alias(match)))
    out = anchors.join(answers, (anchors[key] == answers._ak) & (anchors[anchor_time] == answers._at), "left")
    return out.select(*[anchors[c] for c in anchors.columns], F.col(match))
