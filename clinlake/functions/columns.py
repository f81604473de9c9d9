"""Column standardizers used by the staging layer.

Each function takes a column name or Column and returns a Column built only
from built-in Spark expressions, so every projection stays inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the source warehouse's behaviour.
REASON_CODE_DEFAULT = "-9999999"
REASON_DESCRIPTION_DEFAULT = "not available"
YES = "Yes"
NO = "No"
YES_TEXT = ["1", "true", "TRUE", "Yes", "yes"]
NO_TEXT = ["0", "false", "FALSE", "No", "no"]
# Word delimiters of the warehouse's INITCAP: whitespace plus these characters
# (the apostrophe is not one, so O'BRIEN becomes O'brien).
TITLE_CASE_DELIMITERS = "!?@\"^#$&~_,.:;+-*%/|\\[](){}<>"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == F.lit(""))


def _java_class(chars: str) -> str:
    out = []
    for ch in chars:
        out.append("\\" + ch if ch in "\\[]^-&" else ch)
    return "".join(out)


# a word, or any one delimiter (line breaks too)
TITLE_TOKEN_REGEX = "([^ \\t\\n\\x0B\\f\\r" + _java_class(TITLE_CASE_DELIMITERS) + "]+|(?s:.))"


def reason_code(c: str | Column = "reasoncode", default: str = REASON_CODE_DEFAULT) -> Column:
    return F.coalesce(_c(c), F.lit(default))


def reason_description(c: str | Column = "reasondescription",
                       default: str = REASON_DESCRIPTION_DEFAULT) -> Column:
    return F.coalesce(_c(c), F.lit(default))


def title_case(c: str | Column) -> Column:
    """NULL/blank -> NULL; else capitalise every word of the trimmed text.

    Words are split on whitespace and punctuation (``o-NEIL`` -> ``O-Neil``),
    unlike Spark's ``initcap`` which only splits on whitespace.  The text is
    tokenised into words and single delimiters, each token is capitalised
    and the tokens are joined back: still one JVM expression, no UDF.
    """
    c = _c(c)
    tokens = F.regexp_extract_all(F.trim(c), F.lit(TITLE_TOKEN_REGEX), 1)
    cased = F.transform(tokens, lambda t: F.concat(F.upper(F.substring(t, 1, 1)),
                                                   F.lower(F.substring(t, 2, 1 << 30))))
    return F.when(_blank(c), F.lit(None).cast("string")).otherwise(F.array_join(cased, ""))


def upper_trim(c: str | Column) -> Column:
    c = _c(c)
    return F.when(_blank(c), F.lit(None).cast("string")).otherwise(F.upper(F.trim(c)))


def yes_no(c: str | Column) -> Column:
    """1/true/Yes -> 'Yes', 0/false/No -> 'No', anything else -> NULL."""
    s = _c(c).cast("string")
    return (F.when(s.isNull(), F.lit(None).cast("string"))
            .when(s.isin(YES_TEXT), F.lit(YES))
            .when(s.isin(NO_TEXT), F.lit(NO))
            .otherwise(F.lit(None).cast("string")))


def yes_no_from_boolean(expr: Column) -> Column:
    """True -> 'Yes'; false and NULL -> 'No'."""
    return F.when(expr, F.lit(YES)).otherwise(F.lit(NO))


# Texts that the source reads as a date: ISO, optionally with a time of day
# and zone (both must exist), and its two other automatic formats.  Anything
# else is NULL; a bare cast would also take "2020", "2020-5" or a date followed
# by junk.
_TIME = r"[T ]([01]?[0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9](\.[0-9]{1,9})?)?(Z|[+-](0[0-9]|1[0-8]):[0-5][0-9])?"
ISO_TEXT = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}(" + _TIME + ")?$"
US_DATE = r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})$"
NAMED_MONTH = r"^([0-9]{1,2})-([A-Za-z]{3})-([0-9]{4})$"


def _iso_text(c: str | Column) -> Column:
    """The trimmed text in ISO form, or an empty one where it is in neither of the two numeric formats.

    One expression without branches: it stands wherever a parsed time is used, so it has to stay small."""
    return F.regexp_extract(F.regexp_replace(F.trim(_c(c).cast("string")), US_DATE, "$3-$1-$2"), ISO_TEXT, 0)


def _named_month(c: str | Column) -> Column:
    """Text such as 2-JAN-2020 as a time, anything else as NULL."""
    return F.try_to_timestamp(F.regexp_extract(F.initcap(F.trim(_c(c).cast("string"))), NAMED_MONTH, 0), F.lit("d-MMM-yyyy"))


def parse_date(c: str | Column) -> Column:
    """Safe text -> date; text in no accepted format becomes NULL."""
    return F.coalesce(_iso_text(c).try_cast("date"), _named_month(c).cast("date"))


def parse_timestamp(c: str | Column) -> Column:
    """Safe date / ISO timestamp text -> timestamp_ntz (zone suffix dropped)."""
    return F.coalesce(_iso_text(c).try_cast("timestamp_ntz"), _named_month(c).cast("timestamp_ntz"))


def digits_only(c: str | Column) -> Column:
    stripped = F.regexp_replace(F.trim(_c(c).cast("string")), "[^0-9]", "")
    return F.nullif(stripped, F.lit(""))


def phone_number(c: str | Column = "phone") -> Column:
    """All digits as a whole number of up to 38 digits (longer ones become NULL, as in the source)."""
    return digits_only(c).try_cast("decimal(38,0)")


def state_code(c: str | Column = "state") -> Column:
    return upper_trim(c)


def zip_code(c: str | Column = "zip") -> Column:
    """First five digits, left-padded with zeros; blank -> NULL."""
    c = _c(c)
    return (F.when(c.isNull() | (F.trim(c.cast("string")) == F.lit("")), F.lit(None).cast("string"))
            .otherwise(F.lpad(F.left(digits_only(c), F.lit(5)), 5, "0")))


def entity_name(c: str | Column = "name") -> Column:
    return title_case(c)


address_line_1 = entity_name
address_city = entity_name
address_county = entity_name


def coordinate(c: str | Column) -> Column:
    """Latitude / longitude as double (raises on non-numeric text, like the source)."""
    return _c(c).cast("double")


address_latitude = coordinate
address_longitude = coordinate
# older names of the same cast
latitude = coordinate
longitude = coordinate


def rename_id(c: str | Column, alias: str) -> Column:
    """An id column under its entity-prefixed name (e.g. ``id`` -> ``patient_id``)."""
    return _c(c).alias(alias)


def loaded_at(c: str | Column, run_ts: Column) -> Column:
    """Load time, defaulting to the run timestamp when the raw row has none."""
    return F.coalesce(_c(c).cast("timestamp_ntz"), run_ts)
