"""Broadcasts are bounded by what they are, not by the size of compressed files."""
import pytest
from pyspark.sql import functions as F

from clinlake.operators.point_in_time import join_period_of_year
from clinlake.session import BROADCAST_CONF, configure

STATIC, MEASURED = BROADCAST_CONF


def test_periods_of_many_patients_are_not_broadcast(spark, tmp_path):
    """150,000 patients' periods are some MB of files, and 1.5 million rows when cut into years."""
    (spark.range(150000).select(F.concat(F.lit("P"), F.col("id")).alias("patient_id"), F.make_date(F.lit(1990), F.lit(1), F.lit(1)).alias("effective_from"),
                               F.make_date(F.lit(1999), F.lit(12), F.lit(31)).alias("effective_to"), F.lit(1).alias("scd2_version"))
     .coalesce(1).write.parquet(f"{tmp_path}/periods"))
    (spark.range(40000).select(F.concat(F.lit("P"), F.col("id")).alias("patient_id"), F.col("id").alias("event"), F.make_date(F.lit(1995), F.lit(5), F.lit(5)).alias("d"))
     .write.parquet(f"{tmp_path}/events"))
    configure(spark)
    joined = join_period_of_year(spark.read.parquet(f"{tmp_path}/events"), spark.read.parquet(f"{tmp_path}/periods"), key="patient_id", event_date=F.col("d"),
                                 valid_from="effective_from", valid_to="effective_to", latest=[("effective_from", "desc", "first"), ("scd2_version", "desc", "first")])
    assert joined.filter("pit_patient_id IS NOT NULL").count() == 40000
    joined.write.format("noop").mode("overwrite").save()
    assert "BroadcastExchange" not in joined._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("own", ["-1", "64m"])
def test_a_session_keeps_its_own_thresholds(spark, own):
    saved = spark.conf.get(STATIC), spark.conf.get(MEASURED, None)
    try:
        spark.conf.set(STATIC, own)
        spark.conf.unset(MEASURED)
        configure(spark)
        assert spark.conf.get(STATIC) == own and spark.conf.get(MEASURED, None) is None
        spark.conf.unset(STATIC)
        configure(spark)
        assert (spark.conf.get(STATIC), spark.conf.get(MEASURED)) == tuple(BROADCAST_CONF.values())
    finally:
        spark.conf.set(STATIC, saved[0])
        spark.conf.set(MEASURED, saved[1]) if saved[1] else spark.conf.unset(MEASURED)


def test_event_keys_are_shuffled_as_bytes(spark):
    """Both shuffles of the clinical events carry a key's 16 bytes; the table has its 32 digits."""
    import re

    import __spark_entry__ as E
    from conftest import SF_SMALL

    events = E.queries()["fct_clinical_events"](spark, SF_SMALL)
    assert re.search(r"unhex\(md5\(", events._jdf.queryExecution().optimizedPlan().toString())
    assert events.filter("clinical_event_key RLIKE '^[0-9a-f]{32}$'").count() == events.count() > 0
