"""Data-quality suite: declared column tests, singular checks, freshness and profiles.

Column tests (not_null, unique, accepted_values, relationships,
expression_is_true, each with optional ``where`` and ``warn`` severity)
are declared per model below, exactly as the warehouse declares them.
They are not run one query per test.  Row-level tests (not_null,
accepted_values, expression_is_true) of a model that the run writes are counted
by the write itself (``DataFrame.observe``).  Everything else goes through key
ledgers (:mod:`clinlake.operators.ledger`), one for all row-level tests and one
for each set of keys: a model's bad rows and bad values, or the keys that it
shares with other models, meet in one partially aggregated shuffle, whose files
are deleted before the next ledger is counted.  All results come back as one DataFrame.

Failure counts follow the warehouse's test semantics: not_null and
expression_is_true count rows (NULL passes an expression), unique counts
duplicated values, accepted_values counts distinct invalid values (NULL
passes), relationships counts child rows whose non-NULL value has no parent.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache
from hashlib import md5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinlake.context import Context
from clinlake.operators.ledger import Entry, domain_totals, key_ledger
from clinlake.operators.overlaps import overlap_count
from clinlake.plans import intermediate, marts, reports, staging


@dataclass(frozen=True)
class ColumnTest:
    model: str
    column: str
    kind: str  # not_null | unique | accepted_values | relationships | expression_is_true
    values: tuple = ()
    to: str | None = None  # "model.column" for relationships
    expression: str | None = None
    severity: str = "error"
    where: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.model}_{self.column}"

    @property
    def layer(self) -> str:
        return model_layer_of(self.model)


def model_layer_of(model: str) -> str:
    if model.startswith("source_") or model.startswith("stg_"):
        return "staging"
    if model.startswith("int_"):
        return "intermediate"
    if model.startswith(("dim_", "fct_")):
        return "marts"
    if model.startswith("rpt_"):
        return "reporting"
    return "other"


# -- declarations (fixed values: the warehouse's declared tests) ---------------
YES_NO = ("Yes", "No")
CARE_SETTINGS = ("ambulatory", "inpatient", "emergency", "urgent_care", "wellness", "other")
LAT = "between -90 and 90"
LON = "between -180 and 180"

# model -> [(column, [test, ...])]; a test is a kind name or a tuple
# (kind, argument, {"severity": ..., "where": ...})
DECLARED: dict[str, list] = {
    "source_patients": [("id", ["not_null"]), ("birthdate", ["not_null"])],
    "source_encounters": [("id", ["not_null"]), ("patient_id", ["not_null"])],
    "source_conditions": [("patient_id", ["not_null"]), ("encounter_id", ["not_null"]), ("code", ["not_null"])],
    "source_medications": [("patient_id", ["not_null"]), ("encounter_id", ["not_null"]), ("code", ["not_null"])],
    "source_procedures": [("patient", ["not_null"]), ("encounter", ["not_null"]), ("code", ["not_null"])],
    "source_organizations": [("id", ["not_null"]), ("name", ["not_null"])],
    "source_providers": [("id", ["not_null"]), ("name", ["not_null"])],
    "source_payers": [("id", ["not_null"]), ("name", ["not_null"])],
    "source_payer_transitions": [("patient", ["not_null"]), ("start_year", ["not_null"]), ("payer", ["not_null"])],
    "stg_patients": [
        ("patient_id", ["unique", "not_null"]),
        ("home_address_latitude", [("expression_is_true", LAT)]),
        ("home_address_longitude", [("expression_is_true", LON)]),
        ("loaded_at", ["not_null"])],
    "stg_encounters": [
        ("encounter_id", ["unique", "not_null"]),
        ("patient_id", ["not_null", ("relationships", "stg_patients.patient_id")]),
        ("is_emergency_visit", ["not_null", ("accepted_values", YES_NO)]),
        ("is_inpatient_visit", ["not_null", ("accepted_values", YES_NO)]),
        ("encounter_reason_code", ["not_null"]),
        ("encounter_reason_description", ["not_null"]),
        ("loaded_at", ["not_null"])],
    "stg_conditions": [("patient_id", ["not_null"]), ("encounter_id", ["not_null"]), ("loaded_at", ["not_null"])],
    "stg_medications": [
        ("patient_id", ["not_null"]), ("encounter_id", ["not_null"]), ("medication_reason_code", ["not_null"]),
        ("medication_reason_description", ["not_null"]), ("loaded_at", ["not_null"])],
    "stg_procedures": [
        ("patient_id", ["not_null"]), ("encounter_id", ["not_null"]), ("procedure_reason_code", ["not_null"]),
        ("procedure_reason_description", ["not_null"]), ("loaded_at", ["not_null"])],
    "stg_organizations": [
        ("organization_id", ["unique", "not_null"]),
        ("address_latitude", [("expression_is_true", LAT)]),
        ("address_longitude", [("expression_is_true", LON)]),
        ("loaded_at", ["not_null"])],
    "stg_providers": [
        ("provider_id", ["unique", "not_null"]),
        ("address_latitude", [("expression_is_true", LAT)]),
        ("address_longitude", [("expression_is_true", LON)]),
        ("loaded_at", ["not_null"])],
    "stg_payers": [("payer_id", ["unique", "not_null"]), ("loaded_at", ["not_null"])],
    "stg_payer_transitions": [
        ("patient_id", ["not_null"]), ("coverage_start_year", ["not_null"]), ("payer_id", ["not_null"]),
        ("loaded_at", ["not_null"])],
    "int_patient_insurance_periods": [
        ("patient_id", ["not_null"]),
        ("payer_id", ["not_null", ("relationships", "stg_payers.payer_id")]),
        ("payer_name", ["not_null"]),
        ("effective_from", ["not_null"]),
        ("effective_to", ["not_null"]),
        ("is_current", ["not_null", ("accepted_values", YES_NO)]),
        ("scd2_version", ["not_null", ("expression_is_true", ">= 1")]),
        ("patient_gender", [("accepted_values", ("M", "F", "O", "U"), {"severity": "warn"})])],
    "int_encounter_enriched": [
        ("encounter_id", ["unique", "not_null", ("relationships", "stg_encounters.encounter_id")]),
        ("patient_id", ["not_null", ("relationships", "stg_patients.patient_id")]),
        ("encounter_start_time", ["not_null"]),
        ("care_setting", ["not_null", ("accepted_values", CARE_SETTINGS)]),
        ("total_claim_cost", [("expression_is_true", ">= 0",
                               {"severity": "warn", "where": "total_claim_cost is not null"})]),
        ("encounter_payer_coverage", [("expression_is_true", ">= 0",
                                       {"severity": "warn", "where": "encounter_payer_coverage is not null"})]),
        ("patient_out_of_pocket", [("expression_is_true", ">= 0", {"severity": "warn"})]),
        ("payer_coverage_pct", [("expression_is_true", "between 0 and 100",
                                 {"severity": "warn", "where": "payer_coverage_pct is not null"})]),
        ("is_emergency_visit", ["not_null", ("accepted_values", YES_NO)]),
        ("is_inpatient", ["not_null", ("accepted_values", YES_NO)]),
        ("provider_id", [("relationships", "stg_providers.provider_id", {"severity": "warn"})]),
        ("payer_id", [("relationships", "stg_payers.payer_id", {"severity": "warn"})])],
    "int_readmission_flags": [
        ("index_encounter_id", ["unique", "not_null", ("relationships", "stg_encounters.encounter_id")]),
        ("readmit_encounter_id", [("relationships", "stg_encounters.encounter_id",
                                   {"severity": "warn", "where": "readmit_encounter_id is not null"})]),
        ("patient_id", ["not_null", ("relationships", "stg_patients.patient_id")]),
        ("discharge_date", ["not_null"]),
        ("has_readmission", ["not_null", ("accepted_values", YES_NO)]),
        ("is_30_day_readmission", ["not_null", ("accepted_values", YES_NO)]),
        ("is_7_day_readmission", [("accepted_values", YES_NO)]),
        ("is_90_day_readmission", [("accepted_values", YES_NO)]),
        ("is_same_organization_readmission", [("accepted_values", YES_NO)])],
    "dim_patient": [
        ("patient_key", ["unique", "not_null"]),
        ("patient_id", ["not_null"]),
        ("effective_from", ["not_null"]),
        ("effective_to", ["not_null"]),
        ("is_current", ["not_null", ("accepted_values", YES_NO)]),
        ("payer_id", ["not_null", ("relationships", "dim_payer.payer_id")])],
    "dim_provider": [("provider_key", ["unique", "not_null"]), ("provider_id", ["unique", "not_null"])],
    "dim_organization": [("organization_key", ["unique", "not_null"]), ("organization_id", ["unique", "not_null"])],
    "dim_payer": [("payer_key", ["unique", "not_null"]), ("payer_id", ["unique", "not_null"]),
                  ("payer_name", ["not_null"])],
    "dim_date": [("date_key", ["unique", "not_null"]), ("calendar_date", ["unique", "not_null"]),
                 ("is_weekend", [("accepted_values", YES_NO)])],
    "fct_encounters": [
        ("encounter_key", ["unique", "not_null"]),
        ("encounter_id", ["unique", "not_null"]),
        ("encounter_start_time", ["not_null"]),
        ("care_setting", [("accepted_values", CARE_SETTINGS)]),
        ("patient_key", [("relationships", "dim_patient.patient_key", {"severity": "warn"})]),
        ("provider_key", [("relationships", "dim_provider.provider_key",
                           {"severity": "warn", "where": "provider_key is not null"})]),
        ("organization_key", [("relationships", "dim_organization.organization_key",
                               {"severity": "warn", "where": "organization_key is not null"})]),
        ("payer_key", [("relationships", "dim_payer.payer_key",
                        {"severity": "warn", "where": "payer_key is not null"})]),
        ("encounter_date_key", [("relationships", "dim_date.date_key", {"severity": "warn"})]),
        ("is_emergency_visit", [("accepted_values", YES_NO)]),
        ("is_inpatient", [("accepted_values", YES_NO)])],
    "fct_readmissions": [
        ("readmission_key", ["unique", "not_null"]),
        ("index_encounter_id", ["unique", "not_null"]),
        ("is_30_day_readmission", ["not_null", ("accepted_values", YES_NO)]),
        ("has_readmission", [("accepted_values", YES_NO)]),
        ("patient_key", [("relationships", "dim_patient.patient_key", {"severity": "warn"})])],
    "fct_clinical_events": [
        ("clinical_event_key", ["unique", "not_null"]),
        ("event_type", ["not_null", ("accepted_values", ("condition", "procedure", "medication"))]),
        ("patient_key", [("relationships", "dim_patient.patient_key", {"severity": "warn"})]),
        ("encounter_key", [("relationships", "fct_encounters.encounter_key",
                            {"severity": "warn", "where": "encounter_key is not null"})])],
    "rpt_monthly_encounters": [
        ("year_month", ["not_null"]),
        ("care_setting", ["not_null", ("accepted_values", CARE_SETTINGS)]),
        ("payer_name", ["not_null"]),
        ("encounter_count", ["not_null", ("expression_is_true", ">= 1")])],
    "rpt_readmission_rate_monthly": [
        ("year_month", ["not_null"]),
        ("primary_diagnosis", ["not_null"]),
        ("payer_name", ["not_null"]),
        ("discharge_count", ["not_null", ("expression_is_true", ">= 1")]),
        ("readmission_30day_rate_pct", [("expression_is_true", "between 0 and 100",
                                         {"where": "readmission_30day_rate_pct is not null"})]),
        ("quality_flag", ["not_null", ("accepted_values", ("Alert", "OK"))])],
    "rpt_cost_of_care_annual": [
        ("cost_of_care_key", ["unique", "not_null"]),
        ("patient_id", ["not_null"]),
        ("fiscal_year", ["not_null"]),
        ("cost_category", ["not_null", ("accepted_values", ("High Cost", "Medium Cost", "Low Cost"))])],
    "rpt_provider_performance": [
        ("provider_key", ["unique", "not_null"]),
        ("provider_id", ["not_null"]),
        ("total_encounters", ["not_null", ("expression_is_true", ">= 1")]),
        ("quality_flag", [("accepted_values", ("High Risk (Readmission)", "High Cost", "Low Volume", "OK"))])],
    "rpt_high_risk_patients": [
        ("patient_id", ["not_null"]),
        ("risk_level", ["not_null", ("accepted_values", ("Very High", "High", "Moderate"))]),
        ("primary_risk_factor", [("accepted_values", ("Recent Readmission", "Frequent ED User", "High Cost",
                                                      "Multiple Chronic Conditions", "Other"))])],
}


@cache
def declared_tests() -> tuple[ColumnTest, ...]:
    out = []
    for model, columns in DECLARED.items():
        for column, tests in columns:
            for t in tests:
                kind, arg, opts = (t, None, {}) if isinstance(t, str) else (t[0], t[1], t[2] if len(t) > 2 else {})
                kw = dict(severity=opts.get("severity", "error"), where=opts.get("where"))
                if kind == "accepted_values":
                    kw["values"] = tuple(arg)
                elif kind == "relationships":
                    kw["to"] = arg
                elif kind == "expression_is_true":
                    kw["expression"] = arg
                out.append(ColumnTest(model, column, kind, **kw))
    return tuple(out)


# -- model lookup --------------------------------------------------------------
def model_functions() -> dict:
    fns = {}
    for mod in (staging.STAGING_MODELS, intermediate.INTERMEDIATE_MODELS, marts.MART_MODELS, reports.REPORT_MODELS):
        fns.update(mod)
    fns["dim_date"] = marts.dim_date
    return fns


def model_frame(ctx: Context, model: str) -> DataFrame:
    if model.startswith("source_"):
        return ctx.source(model[len("source_"):])
    return ctx.ref(model_functions()[model])


# -- column tests ----------------------------------------------------------------
RESULT_COLUMNS = ["test_name", "model", "column_name", "test_type", "severity", "failures", "status"]


def _status(failures: Column, severity: Column) -> Column:
    return (F.when(failures > 0, F.when(severity == "warn", F.lit("warn")).otherwise(F.lit("fail")))
            .otherwise(F.lit("pass")))


def _within(t: ColumnTest, condition: str) -> str:
    return condition if t.where is None else f"({t.where}) AND {condition}"


def _violation(t: ColumnTest) -> str:
    """SQL predicate: this row counts as a failure of ``t``."""
    if t.kind == "not_null":
        return _within(t, f"`{t.column}` IS NULL")
    if t.kind == "expression_is_true":
        return _within(t, f"NOT (`{t.column}` {t.expression})")
    if t.kind == "accepted_values":  # NULL passes
        values = ", ".join("'" + v.replace("'", "''") + "'" for v in t.values)
        return _within(t, f"`{t.column}` NOT IN ({values})")
    raise ValueError(t.kind)


ROWS = "rows"


def row_metrics(model: str) -> list[Column]:
    """Metrics that the write of ``model`` collects: its rows, and those that break each of its row-level tests."""
    tests = [t for t in declared_tests() if t.model == model and t.kind in ROW_LEVEL]
    return [F.count(F.lit(1)).alias(ROWS), *[F.expr(f"count_if({_violation(t)})").alias(t.name) for t in tests]]


ROW_LEVEL = ("not_null", "accepted_values", "expression_is_true")


def _observed(ctx: Context, t: ColumnTest) -> int | None:
    """Failures of a test known from the write of its model (None: not known).  How many values break an
    ``accepted_values`` test is only known where no row does."""
    metrics = ctx.observed(t.model)
    if metrics is None or t.kind not in ROW_LEVEL or t not in declared_tests():
        return None
    found = metrics[t.name]
    return found if t.kind != "accepted_values" or found == 0 else None


def _entries(tests: dict[int, ColumnTest], n: int) -> tuple[dict[str, list[Entry]], dict[int, tuple[int, int, str]]]:
    """Ledger entries by model, and for each test the domain, slot and total that hold its failures.  Tests are numbered
    below ``n``, domains of keys from there."""
    entries: dict[str, list[Entry]] = {}
    answers: dict[int, tuple[int, int, str]] = {}
    domains: dict[str, int] = {}  # by parent column
    slots: dict[tuple, tuple[int, int]] = {}
    used: dict[int, int] = {}
    first = n  # a row-level test's domain is its own number

    def add(model: str, domain: int, key: str) -> tuple[int, int]:
        slot = used[domain] = used.get(domain, -1) + 1
        entries.setdefault(model, []).append(Entry(domain, slot, key))
        return domain, slot

    def domain_of(parent: str) -> int:
        if parent not in domains:
            domains[parent] = first + len(domains)
            model, column = parent.split(".")
            slots[parent, None] = add(model, domains[parent], f"`{column}`")
        return domains[parent]

    for i, t in tests.items():
        key = f"`{t.column}`" if t.where is None else f"CASE WHEN {t.where} THEN `{t.column}` END"
        if t.kind == "relationships":
            domain = domain_of(t.to)
            answers[i] = *add(t.model, domain, key), "orphans"
            slots.setdefault((f"{t.model}.{t.column}", t.where), answers[i][:2])
    for i, t in tests.items():
        key = f"`{t.column}`" if t.where is None else f"CASE WHEN {t.where} THEN `{t.column}` END"
        if t.kind == "unique":
            at = f"{t.model}.{t.column}", t.where
            if at not in slots:
                domain = domains[f"{at[0]} where {t.where}"] = first + len(domains)
                slots[at] = add(t.model, domain, key)
            answers[i] = *slots[at], "repeated"
        elif t.kind == "accepted_values":
            answers[i] = *add(t.model, i, f"CASE WHEN {_violation(t)} THEN `{t.column}` END"), "keys"
        elif t.kind in ROW_LEVEL:
            answers[i] = *add(t.model, i, f"CASE WHEN {_violation(t)} THEN '' END"), "rows"
    return entries, answers


def _ledgers(entries: dict[str, list[Entry]], n: int) -> list[dict[str, list[Entry]]]:
    """The entries by ledger: one for all row-level tests (their domains are test numbers, below ``n``; they count rows or
    bad values), and one for each domain of keys."""
    out: dict[int, dict[str, list[Entry]]] = {}
    for model, es in entries.items():
        for e in es:
            out.setdefault(-1 if e.domain < n else e.domain, {}).setdefault(model, []).append(e)
    return [out[k] for k in sorted(out)]


def column_test_results(ctx: Context, tests: list[ColumnTest] | None = None) -> DataFrame:
    ctx = ctx.materialized() if tests is not None else ctx.materialize_warehouse()
    tests = tests if tests is not None else declared_tests()
    known = {i: n for i, t in enumerate(tests) if (n := _observed(ctx, t)) is not None}
    entries, answers = _entries({i: t for i, t in enumerate(tests) if i not in known}, len(tests))
    # one small row per test: what is known, or where in the ledger its failures are
    names = "test_name, model, column_name, test_type, severity, known, domain, slot, total"
    rows = [(t.name, t.model, t.column, t.kind, t.severity, known.get(i), *answers.get(i, (None, None, None))) for i, t in enumerate(tests)]
    cell = lambda v: "NULL" if v is None else str(v) if isinstance(v, int) else f"'{v}'"
    values = ", ".join(f"({', '.join(map(cell, r))})" for r in rows)
    plan = ctx.spark.sql(f"SELECT test_name, model, column_name, test_type, severity, CAST(known AS BIGINT) AS known, "
                         f"CAST(domain AS INT) AS domain, CAST(slot AS INT) AS slot, CAST(total AS STRING) AS total FROM VALUES {values} AS t({names})")
    if not entries:
        return plan.withColumn("failures", F.col("known")).withColumn("status", _status(F.col("failures"), F.col("severity"))).select(*RESULT_COLUMNS)
    # a ledger for each set of keys, whose shuffle files go before the next one is written
    parts = [ctx.once(f"totals_{md5(repr(part).encode()).hexdigest()}", lambda c, part=part: domain_totals(
        key_ledger([(model_frame(c, model), es) for model, es in part.items()]))) for part in _ledgers(entries, len(tests))]
    totals = parts[0]
    for p in parts[1:]:
        totals = totals.unionAll(p)
    found = (F.when(F.col("total") == "keys", F.col("keys")).when(F.col("total") == "rows", F.get("rows", F.col("slot")))
             .when(F.col("total") == "repeated", F.get("repeated", F.col("slot"))).otherwise(F.get("orphans", F.col("slot"))))
    # a domain without keys has no row
    results = plan.join(totals, "domain", "left").withColumn("failures", F.coalesce("known", found, F.lit(0)).cast("bigint"))
    return results.withColumn("status", _status(F.col("failures"), F.col("severity"))).select(*RESULT_COLUMNS)


# -- singular checks (each returns its violating rows) ---------------------------
def _m(ctx, fn):
    return ctx.ref(fn)


def check_stg_encounters_temporal(ctx: Context) -> DataFrame:
    e = _m(ctx, staging.stg_encounters)
    return e.filter(F.col("ended_at").isNotNull() & F.col("started_at").isNotNull()
                    & (F.col("ended_at") < F.col("started_at")))


def check_stg_medications_temporal(ctx: Context) -> DataFrame:
    m = _m(ctx, staging.stg_medications)
    return m.filter(F.col("stopped_at").isNotNull() & F.col("started_at").isNotNull()
                    & (F.col("stopped_at") < F.col("started_at")))


def _labelled(df: DataFrame, label: str, col: str, name_col: str, value_col: str) -> DataFrame:
    return df.filter(F.col(col) < 0).select(F.lit(label).alias(name_col), F.col(col).alias(value_col))


def check_stg_costs_non_negative(ctx: Context) -> DataFrame:
    e, m, p = (_m(ctx, staging.stg_encounters), _m(ctx, staging.stg_medications), _m(ctx, staging.stg_procedures))
    parts = [_labelled(e, "encounters.total_claim_cost", "total_claim_cost", "metric_name", "metric_value"),
             _labelled(e, "encounters.base_encounter_cost", "base_encounter_cost", "metric_name", "metric_value"),
             _labelled(m, "medications.medication_total_cost", "medication_total_cost", "metric_name", "metric_value"),
             _labelled(m, "medications.medication_base_cost", "medication_base_cost", "metric_name", "metric_value"),
             _labelled(p, "procedures.procedure_base_cost", "procedure_base_cost", "metric_name", "metric_value")]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def check_stg_utilization_non_negative(ctx: Context) -> DataFrame:
    o, p = _m(ctx, staging.stg_organizations), _m(ctx, staging.stg_providers)
    return (_labelled(o, "organizations.organization_utilization", "organization_utilization", "metric_name",
                      "metric_value")
            .unionByName(_labelled(p, "providers.provider_utilization", "provider_utilization", "metric_name",
                                   "metric_value")))


def check_stg_payers_coverage(ctx: Context) -> DataFrame:
    p = _m(ctx, staging.stg_payers)
    return p.filter((F.col("amount_covered") < 0) | (F.col("amount_uncovered") < 0) | (F.col("payer_revenue") < 0))


def check_int_insurance_effective_dates(ctx: Context) -> DataFrame:
    p = _m(ctx, intermediate.int_patient_insurance_periods)
    return p.filter(F.col("effective_from") > F.col("effective_to"))


def check_int_scd2_no_overlap(ctx: Context) -> DataFrame:
    """Pairs of a patient's periods where an earlier version ends on or after a
    later version starts.

    Scale form: a row overlaps some earlier version iff the latest
    ``effective_to`` among the patient's earlier versions reaches its
    ``effective_from``.  Versions are ordered by start year first, so that
    running maximum is the larger of (a) a running max inside the
    (patient, start year) bucket and (b) the max over earlier start years,
    taken from one row per bucket; neither window holds all of a patient's
    periods.  Only the flagged rows are then paired with the earlier
    versions that reach them, so the pair join emits the violations and
    nothing else.
    """
    from pyspark.sql import Window

    p = _m(ctx, intermediate.int_patient_insurance_periods).select(
        "patient_id", "scd2_version", "effective_from", "effective_to")
    y = F.year("effective_from")
    seen = Window.unboundedPreceding
    in_year = Window.partitionBy("patient_id", "_y").orderBy("scd2_version").rowsBetween(seen, -1)
    with_y = p.withColumn("_y", y).withColumn("_reach_in", F.max("effective_to").over(in_year))
    years = (with_y.groupBy("patient_id", "_y").agg(F.max("effective_to").alias("_ymax"))
             .withColumn("_reach_before", F.max("_ymax").over(
                 Window.partitionBy("patient_id").orderBy(F.col("_y").asc_nulls_last()).rowsBetween(seen, -1)))
             .select(F.col("patient_id").alias("_yp"), F.col("_y").alias("_yy"), "_reach_before"))
    reach = (with_y.join(years, (with_y.patient_id == years._yp) & with_y._y.eqNullSafe(years._yy), "left")
             .withColumn("_reach", F.greatest("_reach_in", "_reach_before")))
    flagged = (reach.filter(F.col("_reach") >= F.col("effective_from"))
               .select(F.col("patient_id").alias("_pid"), F.col("scd2_version").alias("overlapping_version"),
                       F.col("effective_from").alias("overlapping_effective_from")))
    j = p.join(flagged, (p.patient_id == flagged._pid) & (p.scd2_version < flagged.overlapping_version)
               & (p.effective_to >= flagged.overlapping_effective_from), "inner")
    return j.select("patient_id", "scd2_version", "overlapping_version", "effective_from", "effective_to",
                    "overlapping_effective_from")


def check_int_one_current_per_patient(ctx: Context) -> DataFrame:
    p = _m(ctx, intermediate.int_patient_insurance_periods)
    return (p.filter(F.col("is_current") == "Yes").groupBy("patient_id")
            .agg(F.count(F.lit(1)).alias("current_count")).filter(F.col("current_count") > 1))


def check_int_encounter_temporal(ctx: Context) -> DataFrame:
    e = _m(ctx, intermediate.int_encounter_enriched)
    return e.filter(F.col("encounter_start_time").isNotNull() & F.col("encounter_stop_time").isNotNull()
                    & (F.col("encounter_stop_time") < F.col("encounter_start_time")))


def check_int_coverage_lte_total(ctx: Context) -> DataFrame:
    e = _m(ctx, intermediate.int_encounter_enriched)
    return e.filter(F.col("total_claim_cost").isNotNull() & F.col("encounter_payer_coverage").isNotNull()
                    & (F.col("encounter_payer_coverage") > F.col("total_claim_cost")))


def check_int_readmission_dates(ctx: Context) -> DataFrame:
    r = _m(ctx, intermediate.int_readmission_flags)
    return r.filter(F.col("readmit_encounter_id").isNotNull()
                    & (F.col("readmit_date").isNull() | (F.col("readmit_date") <= F.col("discharge_date"))
                       | (F.col("days_to_readmission") < 0)))


def check_int_readmission_flag_nesting(ctx: Context) -> DataFrame:
    r = _m(ctx, intermediate.int_readmission_flags)
    y = lambda c: F.col(c) == "Yes"
    n = lambda c: F.col(c) == "No"
    return (r.filter(y("is_7_day_readmission") & n("is_30_day_readmission"))
            .unionByName(r.filter(y("is_30_day_readmission") & n("is_90_day_readmission")))
            .unionByName(r.filter(n("has_readmission") & (y("is_7_day_readmission") | y("is_30_day_readmission")
                                                          | y("is_90_day_readmission")))))


def check_marts_encounter_costs_duration(ctx: Context) -> DataFrame:
    f = _m(ctx, marts.fct_encounters)
    parts = [f.filter(F.col(c) < 0).select(F.lit(f"fct_encounters.{c}").alias("issue"),
                                            F.col(c).cast("double").alias("value"))
             for c in ("total_claim_cost", "encounter_payer_coverage", "patient_out_of_pocket")]
    parts.append(f.filter((F.col("duration_hours") < 0) | (F.col("duration_hours") > 1000))
                 .select(F.lit("fct_encounters.duration_hours").alias("issue"),
                         F.col("duration_hours").cast("double").alias("value")))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def check_marts_readmissions_link(ctx: Context) -> DataFrame:
    fr = _m(ctx, marts.fct_readmissions).select("index_encounter_id")
    fe = _m(ctx, marts.fct_encounters).select(F.col("encounter_id").alias("index_encounter_id"))
    return fr.join(fe, "index_encounter_id", "left_anti")


def check_rpt_readmission_rate_range(ctx: Context) -> DataFrame:
    r = _m(ctx, reports.rpt_readmission_rate_monthly)
    base = r.select("year_month", "primary_diagnosis", "payer_name", "discharge_count", "readmission_30day_rate_pct",
                    (F.col("discharge_count") * (F.col("readmission_30day_rate_pct") / F.lit(100.0)))
                    .alias("implied_readmissions"))
    return base.filter((F.col("discharge_count") > 0) & ((F.col("readmission_30day_rate_pct") < 0)
                                                        | (F.col("readmission_30day_rate_pct") > 100)))


SINGULAR = {
    "check_stg_encounters_temporal": ("staging", check_stg_encounters_temporal),
    "check_stg_medications_temporal": ("staging", check_stg_medications_temporal),
    "check_stg_costs_non_negative": ("staging", check_stg_costs_non_negative),
    "check_stg_utilization_non_negative": ("staging", check_stg_utilization_non_negative),
    "check_stg_payers_coverage": ("staging", check_stg_payers_coverage),
    "check_int_insurance_effective_dates": ("intermediate", check_int_insurance_effective_dates),
    "check_int_scd2_no_overlap": ("intermediate", check_int_scd2_no_overlap),
    "check_int_one_current_per_patient": ("intermediate", check_int_one_current_per_patient),
    "check_int_encounter_temporal": ("intermediate", check_int_encounter_temporal),
    "check_int_coverage_lte_total": ("intermediate", check_int_coverage_lte_total),
    "check_int_readmission_dates": ("intermediate", check_int_readmission_dates),
    "check_int_readmission_flag_nesting": ("intermediate", check_int_readmission_flag_nesting),
    "check_marts_encounter_costs_duration": ("marts", check_marts_encounter_costs_duration),
    "check_marts_readmissions_link": ("marts", check_marts_readmissions_link),
    "check_rpt_readmission_rate_range": ("reporting", check_rpt_readmission_rate_range),
}


def count_int_scd2_no_overlap(ctx: Context) -> DataFrame:
    """How many pairs :func:`check_int_scd2_no_overlap` has, without forming them."""
    periods = _m(ctx, intermediate.int_patient_insurance_periods)
    return overlap_count(periods, "patient_id", "effective_from", "effective_to", "scd2_version").select(F.col("pairs").alias("failures"))


# checks whose failures are counted without their rows
COUNTED = {"check_int_scd2_no_overlap": count_int_scd2_no_overlap}


def singular_results(ctx: Context) -> DataFrame:
    """Failures of the singular checks, each counted by an action of its own (once per context): in one plan, the
    stages of all checks start together."""
    ctx = ctx.materialize_warehouse()
    parts = []
    for name, (layer, fn) in SINGULAR.items():
        rows = lambda c, fn=fn: fn(c).agg(F.count(F.lit(1)).alias("failures"))
        counted = ctx.once(f"{name}_failures", COUNTED.get(name, rows))
        parts.append(counted.select(
            F.lit(name).alias("test_name"), F.lit(layer).alias("model"), F.lit(None).cast("string").alias("column_name"),
            F.lit("singular").alias("test_type"), F.lit("error").alias("severity"), "failures"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", _status(F.col("failures"), F.col("severity"))).select(*RESULT_COLUMNS)


def suite_results(ctx: Context) -> DataFrame:
    """Results of all declared and singular tests, computed once per context; the suite's queries share the tables.

    The row-level tests are one action, and so is each set of keys and each singular check: the driver holds a plan, its
    texts and its metrics as long as the action runs, and the disks its shuffle files."""
    ctx = ctx.materialize_warehouse()
    return ctx.once("column_results", column_test_results).unionByName(ctx.once("singular_results", singular_results))


def dq_fused_checks(ctx: Context) -> DataFrame:
    """All 195 declared column tests, one result row each."""
    return suite_results(ctx).filter(F.col("test_type") != "singular")


def dq_singular_checks(ctx: Context) -> DataFrame:
    """Failure counts of the 15 singular checks."""
    return suite_results(ctx).filter(F.col("test_type") == "singular")


# -- freshness, load profile, report profile ----------------------------------------
FRESHNESS_WARN_DAYS = 30
FRESHNESS_ERROR_DAYS = 45


def dq_load_profile(ctx: Context) -> DataFrame:
    """max(_loaded_at), NULL count, row count and malformed rows per raw table (one pass each)."""
    parts = []
    for t in sorted(ctx.raw):
        rejected = ctx.rejected[t].agg(F.count("record").alias("n")).scalar() if t in ctx.rejected else F.lit(0).cast("bigint")
        parts.append(ctx.source(t).agg(F.max("_loaded_at").alias("max_loaded_at"),
                                       F.count_if(F.col("_loaded_at").isNull()).alias("loaded_at_nulls"),
                                       F.count(F.lit(1)).alias("total_rows"))
                     .select(F.lit(t).alias("table_name"), "*", rejected.alias("rejected_rows")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dq_source_freshness(ctx: Context) -> DataFrame:
    """Per raw table: age of the newest load against the as-of date; warn after
    30 days, error after 45, error when nothing has a load time."""
    prof = dq_load_profile(ctx)
    age = F.datediff(ctx.as_of_col(), F.to_date("max_loaded_at"))
    status = (F.when(F.col("max_loaded_at").isNull(), "error")
              .when(age > FRESHNESS_ERROR_DAYS, "error")
              .when(age > FRESHNESS_WARN_DAYS, "warn")
              .otherwise("pass"))
    return prof.select("table_name", "max_loaded_at", age.alias("age_days"), status.alias("freshness_status"))


def dq_report_profile(ctx: Context) -> DataFrame:
    """Row counts of the five reports plus distinct patients with encounters,
    open conditions and the is_current distribution of the patient dimension."""
    ctx = ctx.materialize_warehouse()
    parts = [ctx.ref(fn).agg(F.count(F.lit(1)).alias("value")).select(F.lit(name).alias("metric"), "value")
             for name, fn in reports.REPORT_MODELS.items()]
    parts.append(ctx.ref(intermediate.int_encounter_enriched).agg(F.countDistinct("patient_id").alias("value"))
                 .select(F.lit("distinct_patients_in_encounters").alias("metric"), "value"))
    parts.append(ctx.ref(staging.stg_conditions).filter(F.col("stopped_at").isNull())
                 .agg(F.count(F.lit(1)).alias("value")).select(F.lit("open_conditions").alias("metric"), "value"))
    parts.append(ctx.ref(marts.dim_patient).groupBy("is_current").agg(F.count(F.lit(1)).alias("value"))
                 .select(F.concat(F.lit("is_current="), F.coalesce("is_current", F.lit("NULL"))).alias("metric"),
                         "value"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# -- schema contracts (enforced column names and types of the staging models) -------
# The declared contract, column name and warehouse type, in order.
STAGING_CONTRACTS = {
    "stg_patients": "patient_id varchar, birth_date date, death_date date, social_security_number varchar, "
                    "drivers_license_number varchar, passport_number varchar, name_prefix varchar, first_name varchar, "
                    "last_name varchar, name_suffix varchar, maiden_name varchar, marital_status varchar, race varchar, "
                    "ethnicity varchar, patient_gender varchar, birth_place varchar, home_address_line_1 varchar, "
                    "home_address_city varchar, home_address_county varchar, home_address_state varchar, "
                    "home_address_postal_code varchar, home_address_latitude float, home_address_longitude float, "
                    "healthcare_expenses float, healthcare_coverage float, loaded_at timestamp_ntz",
    "stg_encounters": "encounter_id varchar, started_at timestamp_ntz, ended_at timestamp_ntz, patient_id varchar, "
                      "provider_id varchar, organization_id varchar, payer_id varchar, encounter_class varchar, "
                      "is_emergency_visit varchar, is_inpatient_visit varchar, encounter_code varchar, "
                      "encounter_description varchar, base_encounter_cost float, total_claim_cost float, "
                      "encounter_payer_coverage float, encounter_reason_code varchar, "
                      "encounter_reason_description varchar, loaded_at timestamp_ntz",
    "stg_conditions": "started_at timestamp_ntz, stopped_at timestamp_ntz, patient_id varchar, encounter_id varchar, "
                      "condition_code varchar, condition_description varchar, loaded_at timestamp_ntz",
    "stg_medications": "started_at timestamp_ntz, stopped_at timestamp_ntz, patient_id varchar, payer_id varchar, "
                       "encounter_id varchar, medication_code varchar, medication_description varchar, "
                       "medication_base_cost float, medication_dispense_count number, medication_total_cost float, "
                       "medication_reason_code varchar, medication_reason_description varchar, "
                       "medication_payer_coverage float, loaded_at timestamp_ntz",
    "stg_procedures": "procedure_at timestamp_ntz, patient_id varchar, encounter_id varchar, procedure_code varchar, "
                      "procedure_description varchar, procedure_base_cost float, procedure_reason_code varchar, "
                      "procedure_reason_description varchar, loaded_at timestamp_ntz",
    "stg_providers": "provider_id varchar, organization_id varchar, provider_name varchar, provider_gender varchar, "
                     "provider_specialty varchar, address_line_1 varchar, address_city varchar, address_state varchar, "
                     "address_postal_code varchar, address_latitude float, address_longitude float, "
                     "provider_utilization number, loaded_at timestamp_ntz",
    "stg_organizations": "organization_id varchar, organization_name varchar, address_line_1 varchar, "
                         "address_city varchar, address_state varchar, address_postal_code varchar, "
                         "address_latitude float, address_longitude float, organization_phone_number decimal, "
                         "organization_revenue float, organization_utilization number, loaded_at timestamp_ntz",
    "stg_payers": "payer_id varchar, payer_name varchar, headquarters_address_line_1 varchar, "
                  "headquarters_address_city varchar, headquarters_address_state varchar, "
                  "headquarters_address_postal_code varchar, payer_phone_number decimal, amount_covered float, "
                  "amount_uncovered float, payer_revenue float, covered_encounters number, uncovered_encounters number, "
                  "covered_medications number, uncovered_medications number, covered_procedures number, "
                  "uncovered_procedures number, covered_immunizations number, uncovered_immunizations number, "
                  "unique_customers number, qols_avg float, member_months number, loaded_at timestamp_ntz",
    "stg_payer_transitions": "patient_id varchar, coverage_start_year number, coverage_end_year number, "
                             "payer_id varchar, coverage_ownership_type varchar, loaded_at timestamp_ntz",
}
# warehouse type -> Spark type
CONTRACT_TYPES = {"varchar": "string", "float": "double", "number": "bigint", "decimal": "decimal(38,0)", "date": "date",
                  "timestamp_ntz": "timestamp_ntz"}


def contract_of(model: str) -> list[tuple[str, str]]:
    return [tuple(part.strip().split(" ")) for part in STAGING_CONTRACTS[model].split(",")]


def contract_violations(df: DataFrame, contract: list[tuple[str, str]]) -> list[tuple[str, str, str, str]]:
    """(column, expected, actual, problem) for every column that breaks the contract.

    Reads only the analyzed schema: no Spark job runs.
    """
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    out = []
    for name, wtype in contract:
        want = CONTRACT_TYPES[wtype]
        if name not in actual:
            out.append((name, want, None, "missing"))
        elif actual[name] != want:
            out.append((name, want, actual[name], "type"))
    declared = {n for n, _ in contract}
    out += [(n, None, t, "undeclared") for n, t in actual.items() if n not in declared]
    return out


def dq_schema_contracts(ctx: Context) -> DataFrame:
    """One row per staging model: contract size, violating columns (read from
    the analyzed schema, no job) and the number of rows the contract covers
    (one aggregation per model)."""
    parts = []
    for model in STAGING_CONTRACTS:
        df = model_frame(ctx, model)
        contract = contract_of(model)
        bad = contract_violations(df, contract)
        parts.append(df.agg(F.count(F.lit(1)).alias("rows_checked")).select(
            F.lit(model).alias("model"), F.lit(len(contract)).alias("declared_columns"),
            F.lit(len(bad)).alias("violations"), F.lit("pass" if not bad else "fail").alias("status"),
            "rows_checked"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
