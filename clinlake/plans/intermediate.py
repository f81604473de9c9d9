"""Intermediate layer: insurance periods, enriched encounters, readmission flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.context import Context
from clinlake.functions.columns import yes_no_from_boolean
from clinlake.functions.dates import days_crossed, hours_crossed, round2
from clinlake.operators.first_following import first_following
from clinlake.operators.ranking import sequence_number
from clinlake.plans.staging import (stg_encounters, stg_organizations, stg_patients, stg_payer_transitions,
                                    stg_payers, stg_providers)

# Care settings by lower-cased encounter class.
CARE_SETTINGS = {
    "wellness": "wellness",
    "ambulatory": "ambulatory",
    "emergency": "emergency",
    "urgentcare": "urgent_care",
    "inpatient": "inpatient",
}
OTHER_CARE_SETTING = "other"
OPEN_END_YEAR = 9999
VERSION_TIE_BREAK = ["coverage_end_year", "payer_name", "first_name", "last_name", "patient_gender", "race",
                     "ethnicity", "date_of_birth"]


def care_setting(encounter_class: F.Column) -> F.Column:
    cls = F.lower(encounter_class)
    out = None
    for raw, setting in CARE_SETTINGS.items():
        out = (F if out is None else out).when(cls == raw, F.lit(setting))
    return out.otherwise(F.lit(OTHER_CARE_SETTING))


def int_patient_insurance_periods(ctx: Context) -> DataFrame:
    """One row per patient per coverage period (SCD2 preparation).

    Coverage years become closed date ranges Jan 1 .. Dec 31; an open end
    runs to the end of the as-of year.  ``scd2_version`` numbers a
    patient's periods by start year, then payer id, with
    :func:`~clinlake.operators.ranking.sequence_number`: no task ever holds
    all of one patient's periods, and copies of a period collapse before
    any shuffle.
    """
    pb = ctx.ref(stg_patients).select(
        "patient_id", "first_name", "last_name", "patient_gender", "race", "ethnicity",
        F.col("birth_date").alias("date_of_birth"))
    pt = ctx.ref(stg_payer_transitions).select("patient_id", "payer_id", "coverage_start_year", "coverage_end_year")
    py = ctx.ref(stg_payers).select("payer_id", "payer_name")
    as_of_year = F.year(ctx.as_of_col())
    start_y = F.col("coverage_start_year")
    end_y = F.col("coverage_end_year")
    # numbered by start year then payer, as in the source; the remaining
    # columns only break ties between copies, so that a recomputed task
    # (after an executor loss) numbers them exactly as the first attempt did
    joined = (pb.join(pt, "patient_id", "inner").join(py, "payer_id", "left")
              .select("patient_id", "first_name", "last_name", "patient_gender", "race", "ethnicity",
                      "date_of_birth", "payer_id", "payer_name", "coverage_start_year", "coverage_end_year"))
    numbered = sequence_number(joined, ["patient_id"], ["coverage_start_year", "payer_id"] + VERSION_TIE_BREAK,
                               "scd2_version")
    return numbered.select(
        "patient_id", "first_name", "last_name", "patient_gender", "race", "ethnicity", "date_of_birth",
        "payer_id", "payer_name",
        F.make_date(start_y.cast("int"), F.lit(1), F.lit(1)).alias("effective_from"),
        F.make_date(F.coalesce(end_y, as_of_year.cast("bigint")).cast("int"), F.lit(12), F.lit(31))
         .alias("effective_to"),
        yes_no_from_boolean(F.coalesce(end_y, F.lit(OPEN_END_YEAR)) >= as_of_year).alias("is_current"),
        "scd2_version",
    )


def int_encounter_enriched(ctx: Context) -> DataFrame:
    """Encounters with provider, organization and payer context.

    Ids in the output come from the joined dimension rows, so an id that
    points nowhere becomes NULL.  Dimension sides are joined left; they are
    broadcast only when their measured size is under the broadcast
    threshold (Catalyst estimate, or AQE at runtime), else sort-merged.
    """
    e = ctx.ref(stg_encounters)
    pr = ctx.ref(stg_providers).select(
        F.col("provider_id").alias("pr_provider_id"), "provider_name", "provider_specialty")
    o = ctx.ref(stg_organizations).select(
        F.col("organization_id").alias("o_organization_id"), "organization_name",
        F.col("address_city").alias("organization_city"), F.col("address_state").alias("organization_state"))
    py = ctx.ref(stg_payers).select(F.col("payer_id").alias("py_payer_id"), "payer_name")
    total, cov = F.col("total_claim_cost"), F.col("encounter_payer_coverage")
    return (e.join(pr, e.provider_id == pr.pr_provider_id, "left")
            .join(o, e.organization_id == o.o_organization_id, "left")
            .join(py, e.payer_id == py.py_payer_id, "left")
            .select(
                "encounter_id", "patient_id",
                F.col("started_at").alias("encounter_start_time"),
                F.col("ended_at").alias("encounter_stop_time"),
                hours_crossed("started_at", "ended_at").alias("duration_hours"),
                care_setting(F.col("encounter_class")).alias("care_setting"),
                "base_encounter_cost", "total_claim_cost", "encounter_payer_coverage",
                (F.coalesce(total, F.lit(0.0)) - F.coalesce(cov, F.lit(0.0))).alias("patient_out_of_pocket"),
                round2(F.lit(100.0) * cov / F.nullif(total, F.lit(0.0))).alias("payer_coverage_pct"),
                "is_emergency_visit",
                F.col("is_inpatient_visit").alias("is_inpatient"),
                F.col("pr_provider_id").alias("provider_id"), "provider_name", "provider_specialty",
                F.col("o_organization_id").alias("organization_id"), "organization_name",
                "organization_city", "organization_state",
                F.col("py_payer_id").alias("payer_id"), "payer_name",
                "encounter_reason_code", "encounter_reason_description",
            ))


def inpatient_discharges(ctx: Context) -> DataFrame:
    """Inpatient encounters with a discharge time (the readmission index events)."""
    e = ctx.ref(stg_encounters)
    return (e.filter((F.lower("encounter_class") == "inpatient") & F.col("ended_at").isNotNull())
            .select(F.col("encounter_id").alias("index_encounter_id"), "patient_id",
                    F.col("ended_at").alias("discharge_date"),
                    F.col("organization_id").alias("index_organization_id")))


inpatient_discharges.keep_lazy = True  # one model alone reads it


def int_readmission_flags(ctx: Context) -> DataFrame:
    """One row per inpatient discharge with its first subsequent encounter.

    The next encounter is of any class, starts strictly after the
    discharge instant, and ties at the same instant go to the lowest
    encounter id (see :mod:`clinlake.operators.first_following`).
    """
    d = ctx.ref(inpatient_discharges)
    e = ctx.ref(stg_encounters).select("encounter_id", "patient_id", "started_at", "organization_id")
    m = first_following(d, e, key="patient_id", anchor_time="discharge_date", candidate_time="started_at",
                        tie_break=["encounter_id"], payload=["organization_id"])
    readmit_id = F.col("match.encounter_id")
    days = days_crossed(F.col("discharge_date"), F.col("match.time"))
    within = lambda n: yes_no_from_boolean(days.isNotNull() & (days <= n))
    return m.select(
        "index_encounter_id",
        readmit_id.alias("readmit_encounter_id"),
        "patient_id",
        F.col("index_organization_id").alias("organization_id"),
        "discharge_date",
        F.col("match.time").alias("readmit_date"),
        F.col("match.organization_id").alias("readmit_organization_id"),
        days.alias("days_to_readmission"),
        yes_no_from_boolean(readmit_id.isNotNull()).alias("has_readmission"),
        within(7).alias("is_7_day_readmission"),
        within(30).alias("is_30_day_readmission"),
        within(90).alias("is_90_day_readmission"),
        yes_no_from_boolean(readmit_id.isNotNull()
                            & (F.col("match.organization_id") == F.col("index_organization_id")))
        .alias("is_same_organization_readmission"),
    )


INTERMEDIATE_MODELS = {
    "int_patient_insurance_periods": int_patient_insurance_periods,
    "int_encounter_enriched": int_encounter_enriched,
    "int_readmission_flags": int_readmission_flags,
}
