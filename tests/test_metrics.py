"""metric_query resolution rules."""
import pytest

from clinlake.context import Context
from clinlake.plans import metrics as M
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def ctx(spark):
    return Context.from_bench(spark, SF_SMALL)


def test_declarations_complete():
    assert len(M.METRICS) == 16
    assert len(M.SEMANTIC_MODELS) == 6
    ratios = [m for m in M.METRICS.values() if m.type == "ratio"]
    assert len(ratios) == 5


def test_two_hop_path():
    path = M._join_path(M.SEMANTIC_MODELS["readmissions"], "payer")
    assert [e.name for _, e in path] == ["encounter", "payer"]
    assert M._join_path(M.SEMANTIC_MODELS["encounters"], "encounter") == []
    assert M._join_path(M.SEMANTIC_MODELS["providers"], "payer") is None


def test_no_fan_out_on_joins(ctx):
    base = M.metric_query(ctx, ["total_discharges"], [])
    by_payer = M.metric_query(ctx, ["total_discharges"], ["payer__payer_name"])
    total = base.first()["total_discharges"]
    assert sum(r.total_discharges for r in by_payer.collect()) == total


def test_ratio_is_ratio_of_sums(ctx):
    r = M.metric_query(ctx, ["ed_utilization_rate", "emergency_visits", "total_encounters"], []).first()
    assert abs(r.ed_utilization_rate - r.emergency_visits / r.total_encounters) < 1e-12


def test_unknown_dimension_is_an_error(ctx):
    with pytest.raises(ValueError):
        M.metric_query(ctx, ["total_encounters"], ["encounter__nope"])
    with pytest.raises(ValueError):
        M.metric_query(ctx, ["total_encounters"], ["metric_time__decade"])


def test_global_multi_model_and_two_hop_filter(ctx):
    both = M.metric_query(ctx, ["total_encounters", "total_discharges"], []).collect()
    assert len(both) == 1 and set(both[0].asDict()) == {"total_encounters", "total_discharges"}
    enc = M.metric_query(ctx, ["total_encounters"], []).first().total_encounters
    dis = M.metric_query(ctx, ["total_discharges"], []).first().total_discharges
    assert (both[0].total_encounters, both[0].total_discharges) == (enc, dis)
    # filter on a dimension two hops away from readmissions, grouped by it as well
    by_payer = {r.payer__payer_name: r.total_discharges
                for r in M.metric_query(ctx, ["total_discharges"], ["payer__payer_name"]).collect()}
    name = next(n for n in by_payer if n is not None)
    only = M.metric_query(ctx, ["total_discharges"], [], where=f"payer__payer_name = '{name}'").first()
    assert only.total_discharges == by_payer[name]


def test_order_and_limit_are_a_top_k(ctx):
    top = M.metric_query(ctx, ["total_healthcare_cost"], ["provider__provider_name"],
                         order_by=["-total_healthcare_cost"], limit=3).collect()
    allv = sorted((r.total_healthcare_cost for r in
                   M.metric_query(ctx, ["total_healthcare_cost"], ["provider__provider_name"]).collect()
                   if r.total_healthcare_cost is not None), reverse=True)
    assert [r.total_healthcare_cost for r in top] == allv[:3]


def test_facts_are_aggregated_below_dimension_joins(spark, ctx):
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = M.metric_cost_by_specialty_and_state(ctx)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
    top, join = (next(i for i, x in enumerate(plan) if word in x) for word in ("Aggregate", "Join"))
    assert top < join and any("Aggregate [_j_provider_fk" in x for x in plan[join:]), "\n".join(plan)


def test_distinct_counts_over_a_join(spark, ctx):
    got = M.metric_query(ctx, measures=["patient_count"], group_by=["patient__gender"]).collect()
    rows = ctx.ref(M.dim_patient).select("patient_gender", "patient_id").distinct().groupBy("patient_gender").count().collect()
    assert {r[0]: r[1] for r in got} == {r[0]: r[1] for r in rows}


def test_spine_is_dense(ctx):
    import datetime as dt

    daily = M.metric_inpatient_daily_series(ctx).collect()
    sparse = M.metric_query(ctx, ["total_encounters"], ["metric_time__day", "payer__payer_name"], where="encounter__care_setting = 'inpatient'").collect()
    sparse = [r for r in sparse if r.metric_time__day is not None]
    undated = [r for r in daily if r.metric_time__day is None]
    daily = [r for r in daily if r.metric_time__day is not None]
    assert len(undated) <= 1 + len({r.payer__payer_name for r in undated})
    seen = {(r.metric_time__day, r.payer__payer_name): r.total_encounters for r in sparse}
    days = {d for d, _ in seen}
    names = {n for _, n in seen}
    assert len(daily) == ((max(days) - min(days)).days + 1) * len(names)
    for r in daily:
        assert r.total_encounters == seen.get((r.metric_time__day, r.payer__payer_name), 0)
        assert (r.avg_cost_per_encounter is None and r.ed_utilization_rate is None and r.total_healthcare_cost == 0.0) or r.total_encounters
    monthly = M.metric_query(ctx, ["total_encounters"], ["metric_time__month"], spine=True).collect()
    assert len({r.metric_time__month for r in monthly}) == len(monthly) and all(r.metric_time__month is None or r.metric_time__month.day == 1 for r in monthly)
    none = M.metric_query(ctx, ["total_encounters"], ["metric_time__month"], where="encounter__care_setting = 'nowhere'", spine=True)
    assert none.collect() == []
    with pytest.raises(ValueError):
        M.metric_query(ctx, ["total_encounters"], ["encounter__care_setting"], spine=True)
    assert isinstance(min(days), dt.date)


def test_percentages_are_not_cut(spark):
    """Doubles that are not money keep more than ten decimals in sums and averages."""
    df = spark.createDataFrame([(1e-12,), (3e-12,)], "x double")
    a = M._Aggregate(M.Measure("m", "average", "x"), df)
    got = df.agg(*[c.alias(n) for n, c in a.parts.items()]).select(a.value.alias("m")).first().m
    assert abs(got - 2e-12) < 1e-18
