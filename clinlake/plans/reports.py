"""Five pre-aggregated reports over the star schema.

Calendar attributes of a fact's date key are computed from the key
(:func:`clinlake.functions.dates.calendar_lookup`) rather than joined from
the calendar table: the result equals the left join to ``dim_date`` and
no join or broadcast is planned for it.  Money is summed as fixed-point
decimals so totals do not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.context import Context
from clinlake.functions.dates import calendar_lookup, exact_sum, fiscal_year, money_avg, money_sum, round2, years_crossed
from clinlake.functions.keys import ORPHAN_PAIR_KEY, date_from_key, date_key, part_of, surrogate_key
from clinlake.operators.ranking import top1
from clinlake.plans.intermediate import int_encounter_enriched, int_readmission_flags
from clinlake.plans.marts import (LATEST_PERIOD, dim_organization, dim_patient, dim_payer, dim_provider,
                                  fct_clinical_events, fct_encounters, fct_readmissions)
from clinlake.plans.staging import stg_conditions

# Fixed thresholds and labels of the reports.
UNKNOWN = "Unknown"
READMISSION_ALERT_PCT = 15
HIGH_COST = 100000
MEDIUM_COST = 50000
PROVIDER_READMISSION_RISK_PCT = 20
PROVIDER_HIGH_AVG_COST = 10000
PROVIDER_LOW_VOLUME = 10
PARTS = 2  # of the reports that shuffle most, written one after the other
MONTH_COLUMNS = ["year_month", "year_num", "month_num", "month_name"]


def _yes(c: str) -> F.Column:
    return F.when(F.col(c) == "Yes", F.lit(1)).otherwise(F.lit(0))


def _month_of_key(key: str) -> list[F.Column]:
    d = date_from_key(key)
    return [calendar_lookup(d, n).alias(n) for n in MONTH_COLUMNS]


def _refreshed(ctx: Context) -> F.Column:
    return ctx.run_ts_col().alias("dbt_refreshed_at")


def rpt_monthly_encounters(ctx: Context) -> DataFrame:
    """Encounters by month x care setting x payer."""
    fe = ctx.ref(fct_encounters)
    py = ctx.ref(dim_payer).select(F.col("payer_key").alias("py_payer_key"), "payer_name")
    j = fe.join(py, fe.payer_key == py.py_payer_key, "left")
    total, cov = "total_claim_cost", "encounter_payer_coverage"
    agg = (j.groupBy(*_month_of_key("encounter_date_key"), "care_setting",
                     F.coalesce("payer_name", F.lit(UNKNOWN)).alias("payer_name"))
           .agg(F.countDistinct("encounter_id").alias("encounter_count"),
                F.sum(_yes("is_emergency_visit")).alias("emergency_count"),
                F.sum(_yes("is_inpatient")).alias("inpatient_count"),
                money_sum(total).alias("total_encounter_cost"),
                round2(money_avg(total)).alias("avg_encounter_cost"),
                money_sum(cov).alias("total_payer_coverage"),
                money_sum("patient_out_of_pocket").alias("total_patient_oop"),
                round2(F.avg("duration_hours")).alias("avg_duration_hours"),
                F.max("duration_hours").alias("max_duration_hours"),
                round2(F.lit(100.0) * money_sum(cov) / F.nullif(money_sum(total), F.lit(0.0)))
                .alias("payer_coverage_pct")))
    return agg.select("*", _refreshed(ctx))


def primary_diagnosis(ctx: Context) -> DataFrame:
    """Latest condition per encounter (start date desc, then code): one row per encounter key.

    The top-1 runs before the join to encounters, as a partially aggregated
    ``min``: an encounter with very many conditions never lands in one task.
    """
    ce = (ctx.ref(fct_clinical_events).filter(F.col("event_type") == "condition")
          .select("encounter_key", "event_start_date", "clinical_code", "clinical_description"))
    top = top1(ce, ["encounter_key"], [("event_start_date", "desc", "first"), ("clinical_code", "asc", "last")])
    return top.select("encounter_key", F.col("clinical_description").alias("primary_diagnosis"))


primary_diagnosis.keep_lazy = True  # one report alone reads it


def rpt_readmission_rate_monthly(ctx: Context) -> DataFrame:
    """30-day readmission rate by discharge month x primary diagnosis x payer."""
    fe = ctx.ref(fct_encounters).select("encounter_id", "encounter_key", "payer_key")
    py = ctx.ref(dim_payer).select(F.col("payer_key").alias("py_payer_key"), "payer_name")
    fr = ctx.ref(fct_readmissions).select("index_encounter_id", "discharge_date_key", "is_30_day_readmission")
    # discharges first meet their own encounter (on the encounter id), then
    # the diagnosis (on the encounter key): the big encounter fact is
    # shuffled once, and the second shuffle is only discharge-sized
    re = (fr.join(fe, fr.index_encounter_id == fe.encounter_id, "left")
          .join(ctx.ref(primary_diagnosis), "encounter_key", "left")
          .join(py, F.col("payer_key") == py.py_payer_key, "left"))
    agg = (re.groupBy(*_month_of_key("discharge_date_key"),
                      F.coalesce("primary_diagnosis", F.lit(UNKNOWN)).alias("primary_diagnosis"),
                      F.coalesce("payer_name", F.lit(UNKNOWN)).alias("payer_name"))
           .agg(F.countDistinct("index_encounter_id").alias("discharge_count"),
                F.sum(_yes("is_30_day_readmission")).alias("readmission_30day_count")))
    rate = round2(F.lit(100.0) * F.col("readmission_30day_count").cast("double")
                  / F.nullif(F.col("discharge_count").cast("double"), F.lit(0.0)))
    return (agg.withColumn("readmission_30day_rate_pct", rate)
            .withColumn("quality_flag", F.when(F.col("readmission_30day_rate_pct") > READMISSION_ALERT_PCT, "Alert")
                        .otherwise("OK"))
            .select(*MONTH_COLUMNS, "primary_diagnosis", "payer_name", "discharge_count",
                    "readmission_30day_count", "readmission_30day_rate_pct", "quality_flag", _refreshed(ctx)))


def rpt_cost_of_care_annual(ctx: Context) -> DataFrame:
    """Cost of care per patient x fiscal year (inner join: encounters without a
    valid insurance period are not reported)."""
    return _cost_of_care(ctx, _encounters_of_years(ctx))


def _encounters_of_years(ctx: Context) -> DataFrame:
    # encounters without a period share one key; they cannot meet a patient, so they are not shuffled to one task
    return (ctx.ref(fct_encounters).filter(F.col("patient_key") != ORPHAN_PAIR_KEY)
            .withColumn("fiscal_year", calendar_lookup(date_from_key("encounter_date_key"), "fiscal_year"))
            .filter(F.col("fiscal_year").isNotNull())
            .select("encounter_id", "patient_key", "fiscal_year", "total_claim_cost", "encounter_payer_coverage",
                    "patient_out_of_pocket", "is_emergency_visit", "is_inpatient"))


def _cost_parts(ctx: Context) -> list[DataFrame]:
    """The report in parts: every second (or n-th) fiscal year."""
    e = _encounters_of_years(ctx)
    return [_cost_of_care(ctx, e.filter(F.pmod("fiscal_year", F.lit(PARTS)) == i)) for i in range(PARTS)]


rpt_cost_of_care_annual.parts = _cost_parts


def _cost_of_care(ctx: Context, fe: DataFrame) -> DataFrame:
    dp = ctx.ref(dim_patient).select("patient_key", "patient_id", "first_name", "last_name", "patient_gender", "race")
    j = fe.join(dp, "patient_key", "inner")
    total = "total_claim_cost"
    agg = (j.groupBy("patient_id", "fiscal_year")
           .agg(F.max("first_name").alias("first_name"), F.max("last_name").alias("last_name"),
                F.max("patient_gender").alias("patient_gender"), F.max("race").alias("race"),
                F.countDistinct("encounter_id").alias("encounter_count"),
                F.sum(_yes("is_emergency_visit")).alias("emergency_visit_count"),
                F.sum(_yes("is_inpatient")).alias("inpatient_admission_count"),
                money_sum(total).alias("total_encounter_cost"),
                round2(money_avg(total)).alias("avg_cost_per_encounter"),
                money_sum("encounter_payer_coverage").alias("total_payer_coverage"),
                money_sum("patient_out_of_pocket").alias("total_patient_oop")))
    cost = F.col("total_encounter_cost")
    return (agg.filter(F.col("encounter_count") > 0).select(
        surrogate_key("patient_id", "fiscal_year").alias("cost_of_care_key"),
        "patient_id",
        F.concat("first_name", F.lit(" "), "last_name").alias("patient_name"),
        "patient_gender", "race", "fiscal_year",
        fiscal_year(ctx.as_of_col()).alias("current_fiscal_year"),
        "encounter_count", "emergency_visit_count", "inpatient_admission_count", "total_encounter_cost",
        "avg_cost_per_encounter", "total_payer_coverage", "total_patient_oop",
        F.when(cost > HIGH_COST, "High Cost").when(cost > MEDIUM_COST, "Medium Cost").otherwise("Low Cost")
        .alias("cost_category"),
        _refreshed(ctx)))


def rpt_provider_performance(ctx: Context) -> DataFrame:
    """Provider scorecard: volume, patients, cost, discharges and 30-day readmissions.

    ``unique_patients`` counts distinct patient keys (insurance versions and
    the shared orphan key), as the source warehouse does.
    """
    return _scorecard(ctx, ctx.ref(fct_encounters))


def _scorecard_parts(ctx: Context) -> list[DataFrame]:
    """The scorecard in parts: those of some providers each."""
    e = ctx.ref(fct_encounters)
    return [_scorecard(ctx, e.filter(part_of("provider_key", PARTS) == i)) for i in range(PARTS)]


rpt_provider_performance.parts = _scorecard_parts


def _scorecard(ctx: Context, encounters: DataFrame) -> DataFrame:
    fe = encounters.select(
        "encounter_id", "patient_key", "provider_key", "total_claim_cost", "encounter_payer_coverage",
        "is_emergency_visit", "is_inpatient")
    fr = ctx.ref(fct_readmissions).select("index_encounter_id", F.col("is_30_day_readmission").alias("pr_is_30"))
    j = fe.join(fr, fe.encounter_id == fr.index_encounter_id, "left")
    left = F.col("index_encounter_id").isNotNull()
    sums = {"emergency_encounters": _yes("is_emergency_visit"), "inpatient_encounters": _yes("is_inpatient"),
            "readmission_30day_count": _yes("pr_is_30"), "total_cost": F.col("total_claim_cost"),
            "total_payer_coverage": F.col("encounter_payer_coverage"), "_costs": F.when(F.col("total_claim_cost").isNotNull(), 1)}
    # volume per provider key, before any dimension is joined (one row per encounter here, so plain counts of the ids);
    # sums are kept apart for encounters with and without a discharge
    volume = j.groupBy("provider_key").agg(
        F.count("encounter_id").alias("total_encounters"), F.countDistinct("patient_key").alias("unique_patients"),
        F.count("index_encounter_id").alias("inpatient_discharges"),
        *[exact_sum(F.when(left if with_discharge else ~left, x)).alias(f"{name}_{with_discharge:d}")
          for name, x in sums.items() for with_discharge in (False, True)])
    dpr = ctx.ref(dim_provider).select("provider_key", "provider_id", "provider_name", "provider_specialty",
                                       "organization_id")
    dorg = ctx.ref(dim_organization).select("organization_id", "organization_name", "address_city", "address_state")
    # dimension rows are not unique by construction: ids count once however often a provider or organization is
    # repeated, while sums repeat with the rows of the source's joins (discharges meet the repeated rows twice)
    attributes = ["provider_key", "provider_id", "provider_name", "provider_specialty", "organization_name", "address_city", "address_state"]
    rows = dpr.join(dorg, "organization_id", "left").groupBy(*attributes).agg(F.count(F.lit(1)).alias("_rows"))
    copies = dpr.join(dorg, "organization_id", "left").groupBy(F.col("provider_key").alias("_pk")).agg(F.count(F.lit(1)).alias("_all_rows"))
    known = rows.join(copies, F.col("provider_key") == F.col("_pk")).join(volume, "provider_key")

    def total(name: str) -> F.Column:
        return F.col("_rows") * (F.coalesce(f"{name}_0", F.lit(0)) + F.col("_all_rows") * F.coalesce(f"{name}_1", F.lit(0)))

    costs = F.nullif(total("_costs").cast("double"), F.lit(0.0))
    money = lambda name: F.when(F.coalesce(f"{name}_0", f"{name}_1").isNotNull(), total(name).cast("double"))
    agg = known.select(
        *attributes, "total_encounters", "unique_patients", "inpatient_discharges",
        *[total(n).cast("bigint").alias(n) for n in ("emergency_encounters", "inpatient_encounters", "readmission_30day_count")],
        money("total_cost").alias("total_cost"), round2(money("total_cost") / costs).alias("avg_cost_per_encounter"),
        money("total_payer_coverage").alias("total_payer_coverage"))
    rate = round2(F.lit(100.0) * F.col("readmission_30day_count").cast("double")
                  / F.nullif(F.col("inpatient_discharges").cast("double"), F.lit(0.0)))
    cpv = round2(F.col("total_cost") / F.nullif(F.col("total_encounters").cast("double"), F.lit(0.0)))
    out = agg.withColumn("readmission_30day_rate_pct", rate).withColumn("cost_per_visit", cpv)
    flag = (F.when(F.col("readmission_30day_rate_pct") > PROVIDER_READMISSION_RISK_PCT, "High Risk (Readmission)")
            .when(F.col("avg_cost_per_encounter") > PROVIDER_HIGH_AVG_COST, "High Cost")
            .when(F.col("total_encounters") < PROVIDER_LOW_VOLUME, "Low Volume")
            .otherwise("OK"))
    return (out.filter(F.col("total_encounters") >= 1).select(
        "provider_key", "provider_id", "provider_name", "provider_specialty", "organization_name",
        "address_city", "address_state", "total_encounters", "unique_patients", "emergency_encounters",
        "inpatient_encounters", "total_cost", "avg_cost_per_encounter", "cost_per_visit", "total_payer_coverage",
        "inpatient_discharges", "readmission_30day_count", "readmission_30day_rate_pct",
        flag.alias("quality_flag"), _refreshed(ctx)))


def latest_patient_versions(ctx: Context) -> DataFrame:
    """Latest insurance version of every patient (effective_from, then version,
    descending), as a partially aggregated top-1 per patient."""
    return top1(ctx.ref(dim_patient), ["patient_id"], LATEST_PERIOD)


latest_patient_versions.keep_lazy = True  # one report alone reads it


def rpt_high_risk_patients(ctx: Context) -> DataFrame:
    """Patients scored Moderate or above.

    Quirks kept from the source warehouse: ``readmission_count`` counts all
    inpatient discharges, ``total_cost_ytd`` is all-time and unclamped,
    and ``last_readmission_date`` is the date key of the last discharge
    followed by a 30-day readmission.  All three aggregates are grouped by
    patient id, so they come out hash-partitioned on it and the joins to
    the latest-period patients reuse that partitioning.
    """
    latest = ctx.ref(latest_patient_versions).select("patient_id", "first_name", "last_name", "patient_gender",
                                                      "date_of_birth", "payer_name")
    e = ctx.ref(int_encounter_enriched)
    pe = e.groupBy("patient_id").agg(
        F.countDistinct("encounter_id").alias("total_encounters"),
        money_sum("total_claim_cost").alias("total_cost_ytd"),
        F.sum(_yes("is_emergency_visit")).alias("ed_visit_count"),
        F.max(F.when(F.col("is_emergency_visit") == "Yes", date_key("encounter_start_time")))
        .alias("last_ed_visit_date"))
    r = ctx.ref(int_readmission_flags)
    pr = r.groupBy("patient_id").agg(
        F.countDistinct("index_encounter_id").alias("readmission_count"),
        F.max(F.when(F.col("is_30_day_readmission") == "Yes", date_key("discharge_date")))
        .alias("last_readmission_date"))
    # open conditions, each code and description of a patient once before they are listed
    c = (ctx.ref(stg_conditions).filter(F.col("stopped_at").isNull())
         .groupBy("patient_id", "condition_code", "condition_description").agg(F.count(F.lit(1)).alias("_n")))
    pcc = c.groupBy("patient_id").agg(
        F.countDistinct("condition_code").alias("chronic_condition_count"),
        F.concat_ws(", ", F.sort_array(F.collect_set("condition_description"))).alias("chronic_conditions_list"))
    s = latest.join(pe, "patient_id", "left").join(pr, "patient_id", "left").join(pcc, "patient_id", "left")

    n_readmit = F.coalesce("readmission_count", F.lit(0))
    n_chronic = F.coalesce("chronic_condition_count", F.lit(0))
    n_ed = F.coalesce("ed_visit_count", F.lit(0))
    cost = F.coalesce("total_cost_ytd", F.lit(0.0))
    risk = (F.when((n_readmit >= 2) | ((n_readmit >= 1) & (n_chronic >= 2)), "Very High")
            .when((cost > HIGH_COST) | (n_ed >= 4) | (n_chronic >= 3), "High")
            .when(n_chronic >= 2, "Moderate")
            .otherwise("Low"))
    scored = s.select(
        "patient_id",
        F.concat("first_name", F.lit(" "), "last_name").alias("patient_name"),
        "patient_gender",
        years_crossed("date_of_birth", ctx.as_of_col()).alias("age"),
        "payer_name",
        F.coalesce("total_encounters", F.lit(0)).alias("total_encounters"),
        n_ed.alias("ed_visit_count"),
        "last_ed_visit_date",
        cost.alias("total_cost_ytd"),
        round2(cost / F.nullif(F.col("total_encounters").cast("double"), F.lit(0.0))).alias("avg_cost_per_encounter"),
        n_readmit.alias("readmission_count"),
        "last_readmission_date",
        n_chronic.alias("chronic_condition_count"),
        "chronic_conditions_list",
        risk.alias("risk_level"))
    factor = (F.when(F.col("readmission_count") >= 1, "Recent Readmission")
              .when(F.col("ed_visit_count") >= 3, "Frequent ED User")
              .when(F.col("total_cost_ytd") > HIGH_COST, "High Cost")
              .when(F.col("chronic_condition_count") >= 3, "Multiple Chronic Conditions")
              .otherwise("Other"))
    return (scored.filter(F.col("risk_level").isin("Very High", "High", "Moderate")).select(
        surrogate_key("patient_id").alias("patient_key"), "patient_id", "patient_name", "patient_gender", "age",
        "payer_name", "total_encounters", "ed_visit_count", "last_ed_visit_date", "total_cost_ytd",
        "avg_cost_per_encounter", "readmission_count", "last_readmission_date", "chronic_condition_count",
        "chronic_conditions_list", "risk_level", factor.alias("primary_risk_factor"), _refreshed(ctx)))


REPORT_MODELS = {
    "rpt_monthly_encounters": rpt_monthly_encounters,
    "rpt_readmission_rate_monthly": rpt_readmission_rate_monthly,
    "rpt_cost_of_care_annual": rpt_cost_of_care_annual,
    "rpt_provider_performance": rpt_provider_performance,
    "rpt_high_risk_patients": rpt_high_risk_patients,
}
