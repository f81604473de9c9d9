"""Failure-count semantics of the column tests on a hand-built model."""
import datetime as dt

from clinlake.context import Context
from clinlake.plans import quality as Q


def test_counts_follow_test_semantics(spark):
    df = spark.createDataFrame(
        [("a", "Yes", 1.0), ("a", "Maybe", -1.0), ("b", "Nope", None), (None, "Maybe", 5.0), ("c", None, 2.0)],
        "k string, flag string, v double")
    parent = spark.createDataFrame([("a",)], "k string")
    ctx = Context(spark, {"child": df, "parent": parent})
    tests = [
        Q.ColumnTest("source_child", "k", "not_null"),
        Q.ColumnTest("source_child", "k", "unique"),
        Q.ColumnTest("source_child", "flag", "accepted_values", values=("Yes", "No")),
        Q.ColumnTest("source_child", "v", "expression_is_true", expression=">= 0"),
        Q.ColumnTest("source_child", "v", "expression_is_true", expression=">= 0", where="k = 'b'", severity="warn"),
        Q.ColumnTest("source_child", "k", "relationships", to="source_parent.k", severity="warn"),
    ]
    res = {(r.test_type, r.severity): (r.failures, r.status) for r in Q.column_test_results(ctx, tests).collect()}
    assert res[("not_null", "error")] == (1, "fail")
    assert res[("unique", "error")] == (1, "fail")             # one duplicated value
    assert res[("accepted_values", "error")] == (2, "fail")    # distinct bad values; NULL passes
    assert res[("expression_is_true", "error")] == (1, "fail")  # NULL passes
    assert res[("expression_is_true", "warn")] == (0, "pass")
    assert res[("relationships", "warn")] == (2, "warn")       # b and c; NULL child passes


def test_declared_suite_size():
    tests = Q.declared_tests()
    assert len(tests) == 195
    kinds = {}
    for t in tests:
        kinds[t.kind] = kinds.get(t.kind, 0) + 1
    assert kinds == {"not_null": 113, "accepted_values": 26, "unique": 23, "relationships": 18,
                     "expression_is_true": 15}
    assert sum(t.severity == "warn" for t in tests) == 16
    assert len(Q.SINGULAR) == 15


def test_overlap_check_scale_form_equals_pairs(spark):
    D = dt.date
    rows = [("p", 1, D(1995, 1, 1), D(1996, 12, 31)), ("p", 2, D(1996, 1, 1), D(1997, 12, 31)),
            ("p", 3, D(1997, 6, 1), D(1999, 12, 31)), ("q", 1, D(1995, 1, 1), D(1995, 12, 31))]
    per = spark.createDataFrame(rows, "patient_id string, scd2_version int, effective_from date, effective_to date")
    ctx = Context(spark, {})
    ctx._models["int_patient_insurance_periods"] = per
    got = sorted((r.scd2_version, r.overlapping_version) for r in Q.check_int_scd2_no_overlap(ctx).collect())
    want = sorted((a[1], b[1]) for a in rows for b in rows
                  if a[0] == b[0] and a[1] < b[1] and a[3] >= b[2])
    assert got == want == [(1, 2), (2, 3)]


def test_schema_contracts_hold_and_detect_drift(spark):
    from conftest import SF_SMALL
    from pyspark.sql import functions as F

    ctx = Context.from_bench(spark, SF_SMALL)
    for model in Q.STAGING_CONTRACTS:
        assert Q.contract_violations(Q.model_frame(ctx, model), Q.contract_of(model)) == [], model
    drifted = Q.model_frame(ctx, "stg_payers").withColumn("payer_revenue", F.col("payer_revenue").cast("string")) \
        .drop("qols_avg").withColumn("extra", F.lit(1))
    probs = {p[0]: p[3] for p in Q.contract_violations(drifted, Q.contract_of("stg_payers"))}
    assert probs == {"payer_revenue": "type", "qols_avg": "missing", "extra": "undeclared"}
