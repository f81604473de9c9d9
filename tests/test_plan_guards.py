"""Plan-level guards over every query of the warehouse: no pairwise joins, no
Python evaluation, no sampling -- the whole work stays in Catalyst/Tungsten."""
import pytest

import __spark_entry__ as E
from clinlake.context import Context
from clinlake.plans import catalog, quality, reports
from conftest import SF_SMALL

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF", "Sample "]


@pytest.mark.parametrize("name", sorted(catalog.MODELS))
def test_plan_has_no_pairwise_join_or_python(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = [f for f in FORBIDDEN if f in plan]
    assert not found, f"{name}: {found}"


def test_library_never_collects_to_the_driver():
    import pathlib

    src = pathlib.Path(__file__).resolve().parents[1] / "clinlake"
    offenders = []
    for p in src.rglob("*.py"):
        if "oracle" in p.parts or "llm" in p.parts:
            continue
        text = p.read_text()
        for bad in (".collect()", ".toPandas()", "localCheckpoint", "F.broadcast(", ".hint("):
            if bad in text:
                offenders.append((p.name, bad))
    # the build summary reads back three status counts; nothing else reaches the driver
    assert offenders in ([], [("warehouse.py", ".collect()")]), offenders


def test_suite_reads_tables_by_column(spark):
    """No row-format scans and no row-multiplying Expand in the quality suite or the reports, planned as for large tables."""
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ctx = Context.shared(spark, SF_SMALL)
        for build in (quality.column_test_results, quality.singular_results, quality.dq_report_profile,
                      reports.rpt_provider_performance):
            plan = build(ctx)._jdf.queryExecution().executedPlan().toString()
            assert "ExistingRDD" not in plan and "Expand" not in plan, build.__name__
        plan = E.queries()["rpt_readmission_rate_monthly"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "medication" not in plan and "procedure" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
