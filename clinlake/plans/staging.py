"""Staging layer: one cleaned, typed row per raw row (no filters, joins or dedup)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.context import Context
from clinlake.functions import columns as C


def _loaded(ctx: Context) -> F.Column:
    return C.loaded_at("_loaded_at", ctx.run_ts_col()).alias("loaded_at")


def stg_patients(ctx: Context) -> DataFrame:
    return ctx.source("patients").select(
        C.rename_id("id", "patient_id"),
        C.parse_date("birthdate").alias("birth_date"),
        C.parse_date("deathdate").alias("death_date"),
        C.digits_only("ssn").alias("social_security_number"),
        C.digits_only("drivers").alias("drivers_license_number"),
        F.col("passport").alias("passport_number"),
        C.title_case("prefix").alias("name_prefix"),
        C.title_case("first").alias("first_name"),
        C.title_case("last").alias("last_name"),
        C.title_case("suffix").alias("name_suffix"),
        C.title_case("maiden").alias("maiden_name"),
        C.title_case("marital").alias("marital_status"),
        C.title_case("race").alias("race"),
        C.title_case("ethnicity").alias("ethnicity"),
        C.upper_trim("gender").alias("patient_gender"),
        C.title_case("birthplace").alias("birth_place"),
        C.address_line_1("address").alias("home_address_line_1"),
        C.address_city("city").alias("home_address_city"),
        C.address_county("county").alias("home_address_county"),
        C.state_code("state").alias("home_address_state"),
        C.zip_code("zip").alias("home_address_postal_code"),
        C.address_latitude("lat").alias("home_address_latitude"),
        C.address_longitude("lon").alias("home_address_longitude"),
        F.col("healthcare_expenses"),
        F.col("healthcare_coverage"),
        _loaded(ctx),
    )


def stg_encounters(ctx: Context) -> DataFrame:
    cls = F.lower(F.col("encounterclass"))
    return ctx.source("encounters").select(
        C.rename_id("id", "encounter_id"),
        C.parse_timestamp("START").alias("started_at"),
        C.parse_timestamp("STOP").alias("ended_at"),
        "patient_id", "provider_id", "organization_id", "payer_id",
        F.col("encounterclass").alias("encounter_class"),
        C.yes_no_from_boolean(cls == "emergency").alias("is_emergency_visit"),
        C.yes_no_from_boolean(cls == "inpatient").alias("is_inpatient_visit"),
        F.col("code").alias("encounter_code"),
        F.col("description").alias("encounter_description"),
        "base_encounter_cost", "total_claim_cost",
        F.col("payer_coverage").alias("encounter_payer_coverage"),
        C.reason_code().alias("encounter_reason_code"),
        C.reason_description().alias("encounter_reason_description"),
        _loaded(ctx),
    )


def stg_conditions(ctx: Context) -> DataFrame:
    return ctx.source("conditions").select(
        C.parse_timestamp("START").alias("started_at"),
        C.parse_timestamp("STOP").alias("stopped_at"),
        "patient_id", "encounter_id",
        F.col("code").alias("condition_code"),
        F.col("description").alias("condition_description"),
        _loaded(ctx),
    )


def stg_medications(ctx: Context) -> DataFrame:
    return ctx.source("medications").select(
        C.parse_timestamp("START").alias("started_at"),
        C.parse_timestamp("STOP").alias("stopped_at"),
        "patient_id", "payer_id", "encounter_id",
        F.col("code").alias("medication_code"),
        F.col("description").alias("medication_description"),
        F.col("base_cost").alias("medication_base_cost"),
        F.col("dispenses").alias("medication_dispense_count"),
        F.col("total_cost").alias("medication_total_cost"),
        C.reason_code().alias("medication_reason_code"),
        C.reason_description().alias("medication_reason_description"),
        F.col("payer_coverage").alias("medication_payer_coverage"),
        _loaded(ctx),
    )


def stg_procedures(ctx: Context) -> DataFrame:
    return ctx.source("procedures").select(
        C.parse_timestamp("DATE").alias("procedure_at"),
        F.col("patient").alias("patient_id"),
        F.col("encounter").alias("encounter_id"),
        F.col("code").alias("procedure_code"),
        F.col("description").alias("procedure_description"),
        F.col("base_cost").alias("procedure_base_cost"),
        C.reason_code().alias("procedure_reason_code"),
        C.reason_description().alias("procedure_reason_description"),
        _loaded(ctx),
    )


def stg_providers(ctx: Context) -> DataFrame:
    return ctx.source("providers").select(
        C.rename_id("id", "provider_id"),
        F.col("organization").alias("organization_id"),
        C.entity_name("name").alias("provider_name"),
        C.upper_trim("gender").alias("provider_gender"),
        C.title_case("speciality").alias("provider_specialty"),
        C.address_line_1("address").alias("address_line_1"),
        C.address_city("city").alias("address_city"),
        C.state_code("state").alias("address_state"),
        C.zip_code("zip").alias("address_postal_code"),
        C.address_latitude("lat").alias("address_latitude"),
        C.address_longitude("lon").alias("address_longitude"),
        F.col("utilization").alias("provider_utilization"),
        _loaded(ctx),
    )


def stg_organizations(ctx: Context) -> DataFrame:
    return ctx.source("organizations").select(
        C.rename_id("id", "organization_id"),
        C.entity_name("name").alias("organization_name"),
        C.address_line_1("address").alias("address_line_1"),
        C.address_city("city").alias("address_city"),
        C.state_code("state").alias("address_state"),
        C.zip_code("zip").alias("address_postal_code"),
        C.address_latitude("lat").alias("address_latitude"),
        C.address_longitude("lon").alias("address_longitude"),
        C.phone_number("phone").alias("organization_phone_number"),
        F.col("revenue").alias("organization_revenue"),
        F.col("utilization").alias("organization_utilization"),
        _loaded(ctx),
    )


def stg_payers(ctx: Context) -> DataFrame:
    counts = ["covered_encounters", "uncovered_encounters", "covered_medications",
              "uncovered_medications", "covered_procedures", "uncovered_procedures",
              "covered_immunizations", "uncovered_immunizations", "unique_customers"]
    return ctx.source("payers").select(
        C.rename_id("id", "payer_id"),
        C.entity_name("name").alias("payer_name"),
        C.address_line_1("address").alias("headquarters_address_line_1"),
        C.address_city("city").alias("headquarters_address_city"),
        C.state_code("state_headquartered").alias("headquarters_address_state"),
        C.zip_code("zip").alias("headquarters_address_postal_code"),
        C.phone_number("phone").alias("payer_phone_number"),
        "amount_covered", "amount_uncovered",
        F.col("revenue").alias("payer_revenue"),
        *counts, "qols_avg", "member_months",
        _loaded(ctx),
    )


def stg_payer_transitions(ctx: Context) -> DataFrame:
    return ctx.source("payer_transitions").select(
        F.col("patient").alias("patient_id"),
        F.col("start_year").alias("coverage_start_year"),
        F.col("end_year").alias("coverage_end_year"),
        F.col("payer").alias("payer_id"),
        C.title_case("ownership").alias("coverage_ownership_type"),
        _loaded(ctx),
    )


STAGING_MODELS = {
    "stg_patients": stg_patients,
    "stg_encounters": stg_encounters,
    "stg_conditions": stg_conditions,
    "stg_medications": stg_medications,
    "stg_procedures": stg_procedures,
    "stg_providers": stg_providers,
    "stg_organizations": stg_organizations,
    "stg_payers": stg_payers,
    "stg_payer_transitions": stg_payer_transitions,
}

for _fn in STAGING_MODELS.values():
    _fn.keep_lazy = True
