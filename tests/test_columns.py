"""Column standardizers and keys: the traps listed for the staging layer."""
import datetime as dt

from pyspark.sql import functions as F

from clinlake.functions import columns as C
from clinlake.functions.dates import hours_crossed, round2
from clinlake.functions.keys import ORPHAN_PAIR_KEY, ORPHAN_SINGLE_KEY, date_key, surrogate_key


def one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_title_case_splits_on_punctuation(spark):
    got = one(spark, [("o-NEIL",), ("  mary ann ",), ("",), (None,), ("smith/JONES o'BRIEN",), ("Customer#000000001",)],
              "x string", C.title_case("x"))
    assert got == ["O-Neil", "Mary Ann", None, None, "Smith/Jones O'brien", "Customer#000000001"]


def test_upper_trim_and_state(spark):
    assert one(spark, [(" m ",), (" ",), (None,)], "x string", C.upper_trim("x")) == ["M", None, None]


def test_zip_and_phone(spark):
    assert one(spark, [("123",), ("02134-9999",), (" ",), (None,)], "x string", C.zip_code("x")) == \
        ["00123", "02134", None, None]
    assert one(spark, [("(555) 123-4567",), ("n/a",), (None,)], "x string", C.phone_number("x")) == \
        [5551234567, None, None]


def test_safe_parsing(spark):
    assert one(spark, [("2020-13-01",), ("x",), ("2001-02-03",)], "x string", C.parse_date("x")) == \
        [None, None, dt.date(2001, 2, 3)]
    got = one(spark, [("2010-01-23T17:45:28Z",), ("2010-01-23",), ("x",)], "x string", C.parse_timestamp("x"))
    assert got == [dt.datetime(2010, 1, 23, 17, 45, 28), dt.datetime(2010, 1, 23), None]
    bad = ["2020-01-01 junk", "2020-01-01Tjunk", "2020", "2020-5", "13/13/2020", "2-Foo-2020", "2020-02-30"]
    assert one(spark, [(x,) for x in bad], "x string", C.parse_date("x")) == [None] * len(bad)
    assert one(spark, [(x,) for x in bad], "x string", C.parse_timestamp("x")) == [None] * len(bad)
    good = ["2020-1-2", " 2020-01-02 ", "01/02/2020", "1/2/2020", "2-JAN-2020", "02-jan-2020", "2020-01-02T00:00:00+05:00"]
    assert one(spark, [(x,) for x in good], "x string", C.parse_date("x")) == [dt.date(2020, 1, 2)] * len(good)


def test_cleaning_keeps_every_character(spark):
    texts = ["12 main st\napt 4", "a\r\nb", "a\tb", "a\x0bb", "a`b", "\u00e9a-\u00e9b"]
    assert one(spark, [(x,) for x in texts], "x string", C.title_case("x")) == [
        "12 Main St\nApt 4", "A\r\nB", "A\tB", "A\x0bB", "A`b", "\u00c9a-\u00c9b"]
    assert one(spark, [("1234 5678 9012 3456 7890",), ("9" * 38,), ("9" * 39,)], "x string", C.phone_number("x")) == [
        12345678901234567890, int("9" * 38), None]


def test_yes_no(spark):
    assert one(spark, [("1",), ("false",), ("maybe",), (None,)], "x string", C.yes_no("x")) == ["Yes", "No", None, None]
    assert one(spark, [(True,), (False,), (None,)], "x boolean", C.yes_no_from_boolean(F.col("x"))) == \
        ["Yes", "No", "No"]


def test_hour_boundaries_not_elapsed_hours(spark):
    rows = [(dt.datetime(2001, 1, 1, 10, 50), dt.datetime(2001, 1, 1, 11, 10)),
            (dt.datetime(2001, 1, 1, 10, 0), dt.datetime(2001, 1, 1, 10, 59)),
            (dt.datetime(2001, 1, 1, 11, 0), dt.datetime(2001, 1, 1, 9, 30))]
    assert one(spark, rows, "a timestamp_ntz, b timestamp_ntz", hours_crossed("a", "b")) == [1, 0, -2]


def test_surrogate_keys_never_null(spark):
    df = spark.createDataFrame([(None, None)], "a string, b date")
    r = df.select(surrogate_key("a", "b").alias("k2"), surrogate_key("a").alias("k1")).first()
    assert (r.k2, r.k1) == (ORPHAN_PAIR_KEY, ORPHAN_SINGLE_KEY)


def test_key_text_of_timestamps_has_millis(spark):
    df = spark.createDataFrame([(dt.datetime(2001, 2, 3, 4, 5, 6),)], "t timestamp_ntz")
    got = df.select(surrogate_key("t", df=df)).first()[0]
    import hashlib
    assert got == hashlib.md5(b"2001-02-03 04:05:06.000").hexdigest()


def test_date_key_and_half_up_rounding(spark):
    assert one(spark, [(dt.date(2001, 2, 3),), (None,)], "d date", date_key("d")) == [20010203, None]
    assert one(spark, [(2.005,), (1.004999,), (-2.005,)], "x double", round2(F.col("x"))) == [2.01, 1.0, -2.01]
    assert one(spark, [(2.0049996,), (1e30,), (None,)], "x double", round2(F.col("x"))) == [2.0, 1e30, None]


def test_money_sums(spark):
    from clinlake.functions.dates import money_sum

    assert one(spark, [(0.1,)] * 10 + [(1e-9,)], "x double", money_sum("x")) == [1.000000001]
    nan, = one(spark, [(1.0,), (float("nan"),)], "x double", money_sum("x"))
    assert nan != nan
