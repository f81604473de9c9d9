"""Top-1 per group without a window over the whole group.

``top1`` keeps, for every group, the row that sorts first under an explicit
order.  It is an aggregation (``min`` of a struct whose leading fields are
the sort keys), so each task pre-aggregates its rows before the shuffle: a
group holding a third of all rows collapses to one row per map task instead
of landing whole in one reducer, which a ``row_number`` window would do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

Order = tuple  # (column, "asc"|"desc", "first"|"last")


def _negated(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.DateType):
        return -F.unix_date(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        # the ntz -> ltz cast is monotonic, which is all an ordering needs
        return -F.unix_micros(c.cast("timestamp"))
    if isinstance(dtype, T.NumericType):
        return -c
    raise TypeError(f"descending order on {dtype.simpleString()} column {name!r} is not supported")


def sort_fields(df: DataFrame, order: Sequence[Order]) -> list[Column]:
    """Struct fields whose ascending comparison equals the given ORDER BY."""
    fields = []
    for i, spec in enumerate(order):
        name, direction = spec[0], spec[1] if len(spec) > 1 else "asc"
        nulls = spec[2] if len(spec) > 2 else ("first" if direction == "asc" else "last")
        c = F.col(name)
        # false sorts before true
        flag = c.isNull() if nulls == "last" else c.isNotNull()
        value = c if direction == "asc" else _negated(df, name)
        fields += [flag.alias(f"_n{i}"), value.alias(f"_v{i}")]
    return fields


def top1(df: DataFrame, by: Sequence[str], order: Sequence[Order]) -> DataFrame:
    """One row per ``by`` group: the first row under ``order``.

    Remaining ties are broken by the row's own values, so the choice is
    deterministic.  Output has the input's columns.
    """
    cols, by = df.columns, list(by)
    # an ascending sort field is the column itself, which is shuffled once
    sorted_by = {spec[0]: f"_top._v{i}" for i, spec in enumerate(order) if len(spec) < 2 or spec[1] == "asc"}
    rest = [c for c in cols if c not in by and c not in sorted_by]
    packed = F.struct(*sort_fields(df, order), F.struct(*[F.col(c) for c in rest or by]).alias("_row"))
    top = df.groupBy(*by).agg(F.min(packed).alias("_top"))
    # group keys come from the grouping itself, so a filter on one of them goes below the aggregation
    return top.select(*[F.col(c) if c in by else F.col(sorted_by.get(c, f"_top._row.{c}")).alias(c) for c in cols])


def sequence_number(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str], name: str,
                    chunk: int = 1 << 16) -> DataFrame:
    """``row_number() over (partition by P order by O)`` (O ascending, NULLs
    last) without gathering a partition in one task.

    ``P`` and ``O`` together must name every column, so rows that tie on
    ``O`` are identical and any order among them gives the same output.

    1. Identical rows collapse to (row, multiplicity) -- partial
       aggregation, so copies shrink map-side.
    2. Inside a bucket (P, first order key), distinct rows are numbered by
       the remaining keys with a running sum of multiplicities.
    3. Each bucket's offset is the running total over the partition's
       buckets (a window over distinct leading-key values only).
    4. Multiplicities expand back to rows: every one is cut into descriptors
       of at most ``chunk`` copies, which are dealt out before they expand,
       so no task expands a huge group.
    """
    cols = df.columns
    missing = set(cols) - set(partition_by) - set(order_by)
    if missing:
        raise ValueError(f"sequence_number needs every column in partition_by/order_by; missing {sorted(missing)}")
    lead, rest = order_by[0], list(order_by[1:])
    asc = lambda c: F.col(c).asc_nulls_last()
    bucket = list(partition_by) + [lead]
    rows = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_m"))
    seen = Window.unboundedPreceding
    in_bucket = Window.partitionBy(*bucket).orderBy(*[asc(c) for c in rest]).rowsBetween(seen, -1)
    rows = rows.withColumn("_before", F.coalesce(F.sum("_m").over(in_bucket), F.lit(0)))
    totals = rows.groupBy(*[F.col(c) for c in bucket]).agg(F.sum("_m").alias("_tot"))
    across = Window.partitionBy(*partition_by).orderBy(asc(lead)).rowsBetween(seen, -1)
    offsets = (totals.withColumn("_offset", F.coalesce(F.sum("_tot").over(across), F.lit(0)))
               .select(*[F.col(c).alias(f"_o_{c}") for c in bucket], "_offset"))
    # NULL-safe join on the bucket (the leading key may be NULL)
    cond = None
    for c in bucket:
        e = F.col(c).eqNullSafe(F.col(f"_o_{c}"))
        cond = e if cond is None else cond & e
    numbered = (rows.join(offsets, cond, "inner")
                .select(*cols, "_m", (F.col("_offset") + F.col("_before") + 1).alias("_first")))
    pieces = numbered.select(*cols, "_first", "_m", F.explode(
        F.sequence(F.lit(0).cast("bigint"), F.expr(f"(_m - 1) div {int(chunk)}"))).alias("_c"))
    start = F.col("_first") + F.col("_c") * chunk
    end = F.least(F.col("_first") + F.col("_m") - 1, start + (chunk - 1))
    return (pieces.repartition("_first", "_c", *partition_by)
            .select(*cols, F.explode(F.sequence(start, end)).alias(name))
            .withColumn(name, F.col(name).cast("int")))
