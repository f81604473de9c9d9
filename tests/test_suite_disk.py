"""What the quality suite has on disk at a time: one action's shuffle files beside compact tables."""
import glob
import time

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

import __spark_entry__ as E
from clinlake.context import Context
from clinlake.operators.ledger import Entry, domain_totals, key_ledger
from clinlake.plans import lineage, marts, quality
from clinlake.session import SHUFFLE_CLEANUP, short_lived_shuffles


def shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for f in glob.glob(f"{d.getPath()}/**/shuffle_*.data", recursive=True)}


def test_a_table_of_the_suite_leaves_no_shuffle_files(spark):
    ctx, before = Context.from_bench(spark, SF_SMALL).materialized(), shuffle_files(spark)
    ctx.once("keys", lambda c: spark.range(5000).select((F.col("id") % 100).alias("k")).groupBy("k").count())
    ctx.ref(marts.int_readmission_flags)
    end = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < end:  # they are deleted in the background
        time.sleep(0.2)
    assert not left


def test_the_session_keeps_its_own_setting(spark):
    own = spark.conf.get(SHUFFLE_CLEANUP, "false")
    with pytest.raises(ValueError), short_lived_shuffles(spark):
        with short_lived_shuffles(spark):
            pass
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
        raise ValueError
    assert spark.conf.get(SHUFFLE_CLEANUP) == own


@pytest.mark.parametrize("name", ["fct_encounters", "distinct_clinical_events", "rpt_cost_of_care_annual", "rpt_provider_performance"])
def test_parts_are_the_whole_model(spark, name):
    ctx, model = Context.shared(spark, SF_SMALL), lineage.WRITTEN[name]
    parts = model.parts(ctx)
    whole, n = model(ctx), [p.count() for p in parts]
    assert sum(n) == whole.count() and sum(x > 0 for x in n) > 1
    union = parts[0]
    for p in parts[1:]:
        union = union.unionAll(p)
    assert whole.exceptAll(union).count() == 0


def test_parts_lose_no_null_and_no_other_kind(spark):
    rows = [(p, e, k, "c", "d", None, None, 1.0, 1, 1, None, None) for p in ("a", "b", "", None) for e in ("x", None) for k in ("condition", "other", None)]
    ctx = Context.from_bench(spark, SF_SMALL)
    schema = ", ".join(f"{c} {t}" for c, t in ctx.ref(marts.clinical_event_rows).dtypes)
    ctx._models["clinical_event_rows"] = spark.createDataFrame(rows + rows[:5], schema)
    whole = marts.distinct_clinical_events(ctx)
    got = sum(p.count() for p in marts.distinct_clinical_events.parts(ctx))
    assert got == whole.count() == 3 * 2 * 3  # NULL and '' are one patient to a key


def test_keys_of_events_are_not_stored(spark):
    ctx = Context.shared(spark, SF_SMALL).materialize_warehouse()
    stored = ctx.ref(marts.distinct_clinical_events)
    assert not [c for c in stored.columns if c.endswith("_key")] and "distinct_clinical_events" in stored.inputFiles()[0]
    assert not hasattr(lineage.WRITTEN.get("fct_clinical_events"), "parts")
    whole, direct = ctx.ref(marts.fct_clinical_events), E.queries()["fct_clinical_events"](spark, SF_SMALL)
    assert whole.columns == direct.columns and whole.exceptAll(direct).count() == direct.exceptAll(whole).count() == 0 < whole.count()
    order = [f.__name__ for level in lineage.build_levels(spark) for f in level]
    assert order.index("rpt_cost_of_care_annual") < order.index("distinct_clinical_events") < order.index("rpt_readmission_rate_monthly")


def test_each_set_of_keys_has_a_ledger(spark):
    tests = quality.declared_tests()
    entries, answers = quality._entries(dict(enumerate(tests)), len(tests))
    ledgers = quality._ledgers(entries, len(tests))
    domains = [{e.domain for es in part.values() for e in es} for part in ledgers]
    assert max(domains[0]) < len(tests) and all(len(d) == 1 for d in domains[1:]) and len(domains) > 15
    assert sorted(e.domain for part in ledgers for es in part.values() for e in es) == sorted(e.domain for es in entries.values() for e in es)
    assert {a[0] for a in answers.values()} == set().union(*domains)


def test_keys_of_any_text_stay_apart(spark):
    """Hex digits are shuffled as bytes: none may meet a text of the same bytes."""
    digits = "41" * 16
    texts = ["A" * 16, digits, digits, digits.upper().replace("4", "A"), ("ab" * 16), ("ab" * 16).upper(), "ab" * 16 + "\n", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "k string")
    ledger = key_ledger([(df, [Entry(0, 0, "k")])])
    got = domain_totals(ledger).first()
    assert got["keys"] == len({t for t in texts if t is not None}) and got.repeated == [1] and got.rows == [len(texts) - 1]
    assert max(len(r.key) for r in ledger.filter("n0 = 2").collect()) == 17
