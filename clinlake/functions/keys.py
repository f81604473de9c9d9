"""Surrogate and date keys for the star schema."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

# Fixed text format of timestamps inside hashed keys: the warehouse prints
# timestamp_ntz with milliseconds.
KEY_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
KEY_SEPARATOR = "|"


def _as_key_text(c: Column, dtype=None) -> Column:
    if isinstance(dtype, (TimestampNTZType, TimestampType)):
        return F.date_format(c, KEY_TIMESTAMP_FORMAT)
    return c.cast("string")


def surrogate_key(*fields, df=None) -> Column:
    """md5 over the fields' text, NULL parts as '', joined by '|'.

    ``fields`` are column names or Columns; pass ``df`` so timestamp fields
    are printed with milliseconds.  A literal part is ``F.lit('condition')``.
    Unmatched parts therefore give a constant key (md5('|') for two NULLs),
    never NULL, exactly like the source warehouse.
    """
    parts = []
    for f in fields:
        col = F.col(f) if isinstance(f, str) else f
        dtype = df.schema[f].dataType if (df is not None and isinstance(f, str)) else None
        parts.append(F.coalesce(_as_key_text(col, dtype), F.lit("")))
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def ts_key_text(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, KEY_TIMESTAMP_FORMAT)


def part_of(c: str, parts: int) -> Column:
    """Which of ``parts`` parts the rows of a key are in; NULL and '', the same in a surrogate key, are in one."""
    return F.pmod(F.hash(F.coalesce(c, F.lit(""))), F.lit(parts))


def date_key(c: str | Column) -> Column:
    """YYYYMMDD integer; NULL stays NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyyMMdd").cast("int")


def date_from_key(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.to_date(c.cast("string"), "yyyyMMdd")


ORPHAN_PAIR_KEY = "b99834bc19bbad24580b3adfa04fb947"  # md5('|')
ORPHAN_SINGLE_KEY = "d41d8cd98f00b204e9800998ecf8427e"  # md5('')
