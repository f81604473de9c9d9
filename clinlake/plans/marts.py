"""Star schema: calendar, patient (SCD2), provider, organization and payer
dimensions; encounter, readmission and clinical-event facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.context import Context
from clinlake.functions.columns import yes_no_from_boolean
from clinlake.functions.dates import CALENDAR_END, CALENDAR_GENERATED_DAYS, CALENDAR_START, calendar_attributes
from clinlake.functions.keys import date_key, part_of, surrogate_key, ts_key_text
from clinlake.operators.point_in_time import join_period_of_year, point_in_time_join
from clinlake.operators.ranking import top1
from clinlake.plans.intermediate import int_encounter_enriched, int_patient_insurance_periods, int_readmission_flags
from clinlake.plans.staging import (stg_conditions, stg_encounters, stg_medications, stg_organizations, stg_payers, stg_procedures,
                                    stg_providers)

LATEST_PERIOD = [("effective_from", "desc", "first"), ("scd2_version", "desc", "first")]
PERIOD_COLUMNS = ["patient_id", "effective_from", "effective_to", "scd2_version"]
DURATION_CAP_HOURS = 1000


def _loaded(ctx: Context, name: str = "dbt_loaded_at") -> F.Column:
    return ctx.run_ts_col().alias(name)


# -- dimensions --------------------------------------------------------------
def dim_date(ctx: Context) -> DataFrame:
    """One row per day, 1900-01-01 .. 2030-12-31 (47,847 rows).

    Generated with ``spark.range`` so the rows are produced in parallel
    partitions; it is the only model that reads no source table.
    """
    start = F.lit(CALENDAR_START).cast("date")
    days = (ctx.spark.range(CALENDAR_GENERATED_DAYS)
            .select(F.date_add(start, F.col("id").cast("int")).alias("d"))
            .filter(F.col("d") <= F.lit(CALENDAR_END).cast("date")))
    attrs = calendar_attributes(F.col("d"))
    return days.select(*[c.alias(n) for n, c in attrs.items()], _loaded(ctx))


def dim_patient(ctx: Context) -> DataFrame:
    p = ctx.ref(int_patient_insurance_periods)
    return p.select(
        surrogate_key("patient_id", "effective_from").alias("patient_key"),
        "patient_id", "first_name", "last_name", "date_of_birth", "patient_gender", "race", "ethnicity",
        "payer_id", "payer_name", "effective_from", "effective_to", "is_current", "scd2_version",
        _loaded(ctx))


def dim_provider(ctx: Context) -> DataFrame:
    return (ctx.ref(stg_providers).filter(F.col("provider_id").isNotNull())
            .select(surrogate_key("provider_id").alias("provider_key"), "provider_id", "provider_name",
                    "provider_gender", "provider_specialty", "address_line_1", "address_city", "address_state",
                    "address_postal_code", "organization_id", "provider_utilization", _loaded(ctx)))


def dim_organization(ctx: Context) -> DataFrame:
    return (ctx.ref(stg_organizations).filter(F.col("organization_id").isNotNull())
            .select(surrogate_key("organization_id").alias("organization_key"), "organization_id",
                    "organization_name", "address_line_1", "address_city", "address_state", "address_postal_code",
                    "organization_phone_number", "organization_revenue", "organization_utilization", _loaded(ctx)))


def dim_payer(ctx: Context) -> DataFrame:
    return (ctx.ref(stg_payers).filter(F.col("payer_id").isNotNull())
            .select(surrogate_key("payer_id").alias("payer_key"), "payer_id", "payer_name",
                    F.col("headquarters_address_line_1").alias("address_line_1"),
                    F.col("headquarters_address_city").alias("address_city"),
                    F.col("headquarters_address_state").alias("address_state"),
                    F.col("headquarters_address_postal_code").alias("address_postal_code"),
                    "payer_phone_number", "payer_revenue", _loaded(ctx)))


# -- facts -------------------------------------------------------------------
def insurance_period_ranges(ctx: Context) -> DataFrame:
    """The columns of the insurance periods the point-in-time joins need."""
    return ctx.ref(int_patient_insurance_periods).select(*PERIOD_COLUMNS)


insurance_period_ranges.keep_lazy = True


def _periods(ctx: Context) -> DataFrame:
    return ctx.ref(insurance_period_ranges)


# a repeated event id keeps the row of the latest period (joined columns)
MATCHED_PERIOD = [("pit_" + c, *rest) for c, *rest in LATEST_PERIOD]


def _with_period(ctx: Context, events: DataFrame, event_date: F.Column) -> DataFrame:
    """Events with the latest insurance period valid on their date (periods are whole years)."""
    return join_period_of_year(events, _periods(ctx), key="patient_id", event_date=event_date,
                               valid_from="effective_from", valid_to="effective_to", latest=LATEST_PERIOD)


def _patient_key() -> F.Column:
    # unmatched events hash two empty parts: md5('|'), never NULL
    return surrogate_key(F.col("pit_patient_id"), F.col("pit_effective_from")).alias("patient_key")


def _non_negative(c: str) -> F.Column:
    """Clamp below at 0; NULL stays NULL (unlike Spark's greatest)."""
    return F.when(F.col(c) < 0, F.lit(0.0)).otherwise(F.col(c)).alias(c)


def fct_encounters(ctx: Context) -> DataFrame:
    """One row per encounter, keyed to the insurance period valid on its start date."""
    return _keyed_encounters(ctx, ctx.ref(int_encounter_enriched))


def _encounter_parts(ctx: Context) -> list[DataFrame]:
    """The fact in parts to be written one after the other; copies of an encounter are in one."""
    e = ctx.ref(int_encounter_enriched)
    return [_keyed_encounters(ctx, e.filter(part_of("encounter_id", ENCOUNTER_PARTS) == i)) for i in range(ENCOUNTER_PARTS)]


fct_encounters.parts = _encounter_parts


def _keyed_encounters(ctx: Context, encounters: DataFrame) -> DataFrame:
    # only what the fact keeps is shuffled; names and rates follow from ids and costs, so they break no tie of their own
    e = encounters.filter(F.col("encounter_id").isNotNull()).drop(
        "payer_coverage_pct", "provider_name", "provider_specialty", "organization_name", "organization_city", "organization_state",
        "payer_name")
    pit = top1(_with_period(ctx, e, F.to_date("encounter_start_time")), ["encounter_id"], MATCHED_PERIOD)
    d = F.col("duration_hours")
    return pit.select(
        surrogate_key("encounter_id").alias("encounter_key"),
        "encounter_id",
        _patient_key(),
        surrogate_key("provider_id").alias("provider_key"),
        surrogate_key("organization_id").alias("organization_key"),
        surrogate_key("payer_id").alias("payer_key"),
        date_key("encounter_start_time").alias("encounter_date_key"),
        "encounter_start_time", "encounter_stop_time", "care_setting",
        _non_negative("total_claim_cost"), _non_negative("encounter_payer_coverage"),
        _non_negative("patient_out_of_pocket"), _non_negative("base_encounter_cost"),
        F.when(d < 0, F.lit(0)).when(d > DURATION_CAP_HOURS, F.lit(None)).otherwise(d).alias("duration_hours"),
        "is_emergency_visit", "is_inpatient", "encounter_reason_code", "encounter_reason_description",
        _loaded(ctx))


def fct_readmissions(ctx: Context) -> DataFrame:
    """One row per inpatient discharge, keyed to the period valid on the discharge date."""
    r = ctx.ref(int_readmission_flags).filter(F.col("index_encounter_id").isNotNull())
    pit = top1(_with_period(ctx, r, F.to_date("discharge_date")), ["index_encounter_id"], MATCHED_PERIOD)
    return pit.select(
        surrogate_key("index_encounter_id", "readmit_encounter_id").alias("readmission_key"),
        "index_encounter_id", "readmit_encounter_id",
        _patient_key(),
        surrogate_key("organization_id").alias("organization_key"),
        date_key("discharge_date").alias("discharge_date_key"),
        date_key("readmit_date").alias("readmit_date_key"),
        "days_to_readmission", "is_7_day_readmission", "is_30_day_readmission", "is_90_day_readmission",
        "has_readmission", "is_same_organization_readmission",
        _loaded(ctx))


EVENT_TYPES = ("condition", "procedure", "medication")
EVENT_PARTS = 4
ENCOUNTER_PARTS = 2

# Copies of one event (same patient, encounter, type, code and start) keep
# one row; these fixed tie-breakers make the surviving copy deterministic.
DUPLICATE_TIE_BREAK = [("clinical_description", "asc", "last"), ("event_end_date", "asc", "last"),
                       ("event_cost", "asc", "last"), ("dispense_count", "asc", "last")]


def _event_key() -> F.Column:
    return surrogate_key("patient_id", "encounter_id", "event_type", "clinical_code", ts_key_text("started_at")).alias("clinical_event_key")


EVENT_COLUMNS = ["patient_id", "encounter_id", "event_type", "clinical_code", "clinical_description", "event_start_date", "event_end_date",
                 "event_cost", "dispense_count", "duration_days", "is_chronic_condition"]


def clinical_event_rows(ctx: Context) -> DataFrame:
    """Conditions, procedures and medications in the columns of events, with the instant each began."""
    as_of = ctx.as_of_col()
    null = lambda t: F.lit(None).cast(t)

    def duration(start, stop):
        return F.datediff(F.coalesce(F.to_date(stop), as_of), F.to_date(start))

    cond = ctx.ref(stg_conditions).select(
        "patient_id", "encounter_id",
        F.lit("condition").alias("event_type"), F.col("condition_code").alias("clinical_code"),
        F.col("condition_description").alias("clinical_description"),
        F.to_date("started_at").alias("event_start_date"), F.to_date("stopped_at").alias("event_end_date"),
        null("double").alias("event_cost"), null("bigint").alias("dispense_count"),
        duration("started_at", "stopped_at").alias("duration_days"),
        yes_no_from_boolean(F.col("stopped_at").isNull()).alias("is_chronic_condition"), "started_at")
    proc = ctx.ref(stg_procedures).select(
        "patient_id", "encounter_id",
        F.lit("procedure").alias("event_type"), F.col("procedure_code").alias("clinical_code"),
        F.col("procedure_description").alias("clinical_description"),
        F.to_date("procedure_at").alias("event_start_date"), null("date").alias("event_end_date"),
        F.col("procedure_base_cost").alias("event_cost"), null("bigint").alias("dispense_count"),
        null("int").alias("duration_days"), null("string").alias("is_chronic_condition"), F.col("procedure_at").alias("started_at"))
    med = ctx.ref(stg_medications).select(
        "patient_id", "encounter_id",
        F.lit("medication").alias("event_type"), F.col("medication_code").alias("clinical_code"),
        F.col("medication_description").alias("clinical_description"),
        F.to_date("started_at").alias("event_start_date"), F.to_date("stopped_at").alias("event_end_date"),
        F.col("medication_total_cost").alias("event_cost"),
        F.col("medication_dispense_count").alias("dispense_count"),
        duration("started_at", "stopped_at").alias("duration_days"), null("string").alias("is_chronic_condition"), "started_at")
    return cond.unionByName(proc).unionByName(med)


def clinical_events_union(ctx: Context) -> DataFrame:
    """Conditions, procedures and medications aligned to one 12-column event shape."""
    return ctx.ref(clinical_event_rows).select(_event_key(), *EVENT_COLUMNS)


def distinct_clinical_events(ctx: Context) -> DataFrame:
    """Distinct clinical events with the first day of the period valid on their start date, without their keys.

    Copies of an event share patient and start date, hence the same valid
    periods, so they are collapsed first (a partially aggregated top-1:
    copies never gather in one task), and the point-in-time join then runs
    on distinct events only, whose keys stay unique.  Keys follow from the
    other columns; written out, their digits were four fifths of the table.
    """
    return _distinct_events(ctx, ctx.ref(clinical_event_rows))


def _distinct_events(ctx: Context, rows: DataFrame) -> DataFrame:
    # event_type is part of the hashed key; as a group key of its own, a filter on it reaches the sources
    # the key is shuffled once, as its 16 bytes and not as their 32 digits
    keyed = rows.withColumn("clinical_event_key", F.unhex(_event_key()))
    events = top1(keyed, ["clinical_event_key", "event_type"], DUPLICATE_TIE_BREAK).drop("clinical_event_key")
    pit = _with_period(ctx, events, F.col("event_start_date"))
    return pit.select(*EVENT_COLUMNS, "started_at", F.col("pit_effective_from").alias("period_from"))


def _event_parts(ctx: Context) -> list[DataFrame]:
    """The distinct events in parts to be written one after the other: those of each type (and of any other) for some
    of the patients.  Copies share both, so the parts have no event in common; the filters reach the sources."""
    rows, kind = ctx.ref(clinical_event_rows), F.col("event_type")
    kinds = [*[kind == t for t in EVENT_TYPES], kind.isNull() | ~kind.isin(*EVENT_TYPES)]
    return [_distinct_events(ctx, rows.filter(k & (part_of("patient_id", EVENT_PARTS) == i))) for k in kinds for i in range(EVENT_PARTS)]


distinct_clinical_events.parts = _event_parts
distinct_clinical_events.written_late = True


def fct_clinical_events(ctx: Context) -> DataFrame:
    """One row per distinct clinical event, keyed to the insurance period valid on its start date."""
    found = F.col("period_from").isNotNull()
    return ctx.ref(distinct_clinical_events).select(
        _event_key(),
        surrogate_key(F.when(found, F.col("patient_id")), F.col("period_from")).alias("patient_key"),
        surrogate_key("encounter_id").alias("encounter_key"),
        date_key("event_start_date").alias("event_date_key"),
        "event_type", "clinical_code", "clinical_description", "event_start_date", "event_end_date",
        "event_cost", "dispense_count", "duration_days", "is_chronic_condition",
        _loaded(ctx))


def encounter_active_medication(ctx: Context) -> DataFrame:
    """Every encounter with the latest started medication that its patient takes on its start date.

    Courses begin and end on any day; an open one runs to the as-of date.  Of courses begun on the same day the
    first code wins, and of copies the one that ends last."""
    courses = ctx.ref(stg_medications).select(
        "patient_id", "medication_code", F.to_date("started_at").alias("medication_from"),
        F.coalesce(F.to_date("stopped_at"), ctx.as_of_col()).alias("medication_to"))
    visits = ctx.ref(stg_encounters).select("encounter_id", "patient_id", F.to_date("started_at").alias("encounter_date"))
    found = point_in_time_join(visits, courses, key="patient_id", event_date=F.col("encounter_date"),
                               valid_from="medication_from", valid_to="medication_to",
                               latest=[("medication_from", "desc", "first"), ("medication_code", "asc", "last"), ("medication_to", "desc", "last")])
    return found.select("encounter_id", "patient_id", "encounter_date",
                        *[F.col(f"pit_{c}").alias(c) for c in ("medication_code", "medication_from", "medication_to")])


# projections of a source or of a checkpointed model, and what one model alone reads: never worth a checkpoint
for _fn in (dim_date, dim_patient, dim_provider, dim_organization, dim_payer, clinical_event_rows, clinical_events_union, fct_clinical_events):
    _fn.keep_lazy = True

MART_MODELS = {
    "dim_patient": dim_patient,
    "dim_provider": dim_provider,
    "dim_organization": dim_organization,
    "dim_payer": dim_payer,
    "fct_encounters": fct_encounters,
    "fct_readmissions": fct_readmissions,
    "fct_clinical_events": fct_clinical_events,
}
