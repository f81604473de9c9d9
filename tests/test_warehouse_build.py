"""Full build to tables, suite run and audit log (append twice, evolving schema)."""
import tempfile

from pyspark.sql import functions as F

from clinlake.context import Context
from clinlake.plans import audit, warehouse
from conftest import SF_SMALL


def test_build_tests_and_audit(spark):
    out = tempfile.mkdtemp(prefix="clinlake-pipe-")
    ctx = Context.from_bench(spark, SF_SMALL)
    summary = warehouse.run(ctx, out)
    assert set(summary["tables"]) >= {"dim_date", "fct_encounters", "rpt_high_risk_patients"}
    assert sum(summary["tests"].values()) == 210
    # second run with an extra column: the log keeps both, old rows read NULL
    res = warehouse.run_tests(ctx.materialized())
    rows = audit.audit_rows(res, "second", ctx.run_ts, ctx.run_ts).withColumn("extra_note", F.lit("x"))
    for _ in range(2):  # a repeated run leaves its rows once
        audit.log_test_results(rows, f"{out}/audit/test_results", "second")
    log = audit.read_audit(spark, f"{out}/audit/test_results")
    assert log.count() == 420
    assert log.filter(F.col("extra_note").isNull()).count() == 210
    stages = {r.stage for r in audit.audit_stage_summary(log).collect()}
    assert stages <= {"staging", "intermediate", "marts", "reporting"}
    assert audit.latest_audit_rows(log).count() == 10
    t = audit.audit_totals(log).first()
    assert t.total_tests == 210


def test_bucketed_facts_join_without_shuffle(spark):
    from clinlake.plans import reports

    out = tempfile.mkdtemp(prefix="clinlake-bucket-")
    ctx = Context.from_bench(spark, SF_SMALL)
    warehouse.build(ctx, out, models=["fct_encounters", "fct_readmissions", "fct_clinical_events"],
                   database="clinlake_bucket_test")
    fe = spark.table("clinlake_bucket_test.fct_encounters")
    fr = spark.table("clinlake_bucket_test.fct_readmissions")
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # plan as for large tables
    try:
        j = fr.join(fe, fr.index_encounter_id == fe.encounter_id, "left")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
        top = reports.primary_diagnosis(ctx)  # reads the bucketed clinical events table
        assert "Exchange" not in top._jdf.queryExecution().executedPlan().toString()
        assert j.count() == fr.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)


def test_one_file_per_bucket(spark):
    import glob

    out = tempfile.mkdtemp(prefix="clinlake-files-")
    ctx = Context.from_bench(spark, SF_SMALL)
    saved = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        paths = warehouse.build(ctx, out, models=list(warehouse.FACT_BUCKETS), buckets=16)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", saved)
    for name in warehouse.FACT_BUCKETS:
        assert len(glob.glob(f"{paths[name]}/part-*")) == 16, name


def test_builds_to_two_folders_keep_their_tables(spark):
    first, second = (tempfile.mkdtemp(prefix="clinlake-two-") for _ in range(2))
    ctx = Context.from_bench(spark, SF_SMALL)
    warehouse.build(ctx, first, models=["fct_readmissions"], buckets=4)
    before = ctx.ref(warehouse.marts.fct_readmissions)
    warehouse.build(Context.from_bench(spark, SF_SMALL), second, models=["fct_readmissions"], buckets=4)
    assert all(f"{first}/" in f for f in before.inputFiles())
    assert warehouse.bucket_count(ctx) >= warehouse.LEAST_BUCKETS


def test_a_failed_build_leaves_the_old_one(spark):
    import pytest

    from clinlake.sources import sinks

    out = tempfile.mkdtemp(prefix="clinlake-atomic-")
    with pytest.raises(FileNotFoundError):
        sinks.read_table(spark, out, "marts", "dim_payer")
    models = ["dim_payer", "fct_readmissions", "rpt_monthly_encounters"]
    warehouse.build(Context.from_bench(spark, SF_SMALL), out, models=models, buckets=2)
    first = sinks.current_build(spark, out)
    held = sinks.read_table(spark, out, "marts", "dim_payer")
    before = sorted(map(tuple, held.collect()))

    broken = Context.from_bench(spark, SF_SMALL)
    broken.raw["payers"] = broken.raw["payers"].limit(2)
    lost = dict(broken.raw)
    del lost["encounters"]  # facts cannot be built
    broken.raw = lost
    with pytest.raises(Exception):
        warehouse.build(broken, out, models=models, buckets=2)
    assert sinks.current_build(spark, out) == first
    assert sorted(map(tuple, sinks.read_table(spark, out, "marts", "dim_payer").collect())) == before

    changed = Context.from_bench(spark, SF_SMALL)
    changed.raw["payers"] = changed.raw["payers"].limit(2)
    warehouse.build(changed, out, models=["dim_payer"], buckets=2)
    assert sinks.current_build(spark, out) != first
    assert sinks.read_table(spark, out, "marts", "dim_payer").count() == 2
    assert sorted(map(tuple, held.collect())) == before  # a reader of the old build keeps it
    assert len(sinks.drop_old_builds(spark, out, keep=1)) == 2
    assert sinks.read_table(spark, out, "marts", "dim_payer").count() == 2


def test_write_counts_what_the_tests_ask(spark):
    """Row-level tests of written models come from the write; without its counts the ledger scans, with equal results."""
    from clinlake.plans import quality

    ctx = Context.from_bench(spark, SF_SMALL).materialize_warehouse()
    assert {"fct_encounters", "int_encounter_enriched", "rpt_high_risk_patients"} <= set(ctx._observed)
    observed = sorted(map(tuple, quality.column_test_results(ctx).collect()), key=repr)
    ctx._observed.clear()
    assert sorted(map(tuple, quality.column_test_results(ctx).collect()), key=repr) == observed


def test_recorded_lineage(spark):
    from clinlake.plans import lineage

    reads = lineage.reads(spark)
    assert reads["int_patient_insurance_periods"] == ("stg_patients", "stg_payer_transitions", "stg_payers")
    assert reads["check_marts_readmissions_link"] == ("fct_readmissions", "fct_encounters")
    assert reads["stg_payers"] == ("source_payers",)
    levels = [{f.__name__ for f in level} for level in lineage.build_levels(spark)]
    assert sum(map(len, levels)) == len(lineage.WRITTEN)
    at = {name: i for i, level in enumerate(levels) for name in level}
    assert at["int_encounter_enriched"] < at["fct_encounters"] < at["rpt_monthly_encounters"]
    assert at["fct_readmissions"] < at["rpt_readmission_rate_monthly"]


def test_results_follow_changed_files(spark):
    import shutil

    folder = tempfile.mkdtemp(prefix="clinlake-state-")
    shutil.copytree(SF_SMALL, f"{folder}/sf")
    ctx = Context.shared(spark, f"{folder}/sf")
    assert Context.shared(spark, f"{folder}/sf") is ctx
    shutil.copy("/root/testdata/sf0.01/supplier.parquet", f"{folder}/sf/new.parquet")
    assert Context.shared(spark, f"{folder}/sf") is not ctx


def test_models_are_views_by_name(spark):
    names = warehouse.create_views(Context.shared(spark, SF_SMALL))
    assert {"source_payers", "stg_payers", "int_encounter_enriched", "dim_date", "rpt_monthly_encounters"} <= set(names)
    payers, sources = spark.sql("SELECT (SELECT count(*) FROM stg_payers), (SELECT count(*) FROM source_payers)").first()
    assert payers == sources > 0
    assert spark.sql("SELECT care_setting FROM int_encounter_enriched WHERE is_inpatient = 'Yes'").columns == ["care_setting"]
