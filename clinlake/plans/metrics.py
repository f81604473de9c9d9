"""Metric layer: semantic models, measures and metrics, and ``metric_query``.

The declarations mirror the warehouse's semantic layer: six semantic
models over the marts, each with entities (primary / foreign / unique),
measures (count, sum, average, count_distinct over an expression) and
dimensions (categorical, or time with a day grain); sixteen metrics are
simple (one measure) or ratios (numerator and denominator aggregated
separately, then divided).

``metric_query`` compiles a request into one aggregation per semantic model,
in two steps where dimensions are joined (below the join and above it):

* a group-by item ``entity__dimension`` is resolved on the model itself or
  through many-to-one entity joins (a foreign entity to the model where it
  is primary), at most two hops, so no join fans out;
* ``metric_time__<grain>`` truncates each model's default time dimension;
* metrics from several models are aggregated separately and aligned with a
  full outer join on the group-by columns (NULL-safe), the standard way to
  combine metrics whose base tables have different grains.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinlake.context import Context
from clinlake.functions.dates import MONEY, WIDE
from clinlake.operators.series import dense_series
from clinlake.plans.marts import dim_organization, dim_patient, dim_payer, dim_provider, fct_encounters, fct_readmissions

GRAINS = ("day", "week", "month", "quarter", "year")


@dataclass(frozen=True)
class Entity:
    name: str
    type: str  # primary | foreign | unique
    expr: str


@dataclass(frozen=True)
class Measure:
    name: str
    agg: str  # count | sum | average | count_distinct
    expr: str
    money: bool = False  # a double of at most ten decimals


@dataclass(frozen=True)
class Dimension:
    name: str
    expr: str
    type: str = "categorical"  # categorical | time


@dataclass(frozen=True)
class SemanticModel:
    name: str
    model: Callable[[Context], DataFrame]
    entities: tuple[Entity, ...]
    measures: tuple[Measure, ...] = ()
    dimensions: tuple[Dimension, ...] = ()
    agg_time_dimension: str | None = None

    @property
    def is_fact(self) -> bool:
        return self.model.__name__.startswith("fct_")

    @property
    def primary(self) -> Entity | None:
        return next((e for e in self.entities if e.type == "primary"), None)

    def entity(self, name: str) -> Entity | None:
        return next((e for e in self.entities if e.name == name), None)

    def dimension(self, name: str) -> Dimension | None:
        return next((d for d in self.dimensions if d.name == name), None)


@dataclass(frozen=True)
class Metric:
    name: str
    type: str  # simple | ratio
    measure: str | None = None
    numerator: str | None = None
    denominator: str | None = None
    label: str = ""


# -- declarations (fixed values of the semantic layer) -------------------------
YES_ONE = "case when {c} = 'Yes' then 1 else 0 end"

SEMANTIC_MODELS: dict[str, SemanticModel] = {m.name: m for m in [
    SemanticModel(
        "encounters", fct_encounters,
        entities=(Entity("encounter", "primary", "encounter_id"), Entity("patient", "foreign", "patient_key"),
                  Entity("provider", "foreign", "provider_key"), Entity("payer", "foreign", "payer_key"),
                  Entity("organization", "foreign", "organization_key")),
        measures=(
            Measure("encounter_count", "count", "encounter_id"),
            Measure("emergency_visit_count", "sum", YES_ONE.format(c="is_emergency_visit")),
            Measure("inpatient_admission_count", "sum", YES_ONE.format(c="is_inpatient")),
            Measure("total_encounter_cost", "sum", "total_claim_cost", money=True),
            Measure("avg_encounter_cost", "average", "total_claim_cost", money=True),
            Measure("total_payer_coverage", "sum", "encounter_payer_coverage", money=True),
            Measure("total_patient_oop", "sum", "patient_out_of_pocket", money=True),
            Measure("avg_duration_hours", "average", "duration_hours"),
            Measure("payer_coverage_pct", "average",
                    "case when total_claim_cost > 0 "
                    "then (encounter_payer_coverage / total_claim_cost) * 100 else 0 end"),
        ),
        dimensions=(
            Dimension("encounter_id", "encounter_id"),
            Dimension("encounter_date", "encounter_start_time", "time"),
            Dimension("care_setting", "care_setting"),
            Dimension("is_emergency", "is_emergency_visit"),
            Dimension("is_inpatient", "is_inpatient"),
        ),
        agg_time_dimension="encounter_date"),
    SemanticModel(
        "readmissions", fct_readmissions,
        entities=(Entity("readmission", "primary", "readmission_key"),
                  Entity("encounter", "foreign", "index_encounter_id"),
                  Entity("patient", "foreign", "patient_key"), Entity("organization", "foreign", "organization_key")),
        measures=(
            Measure("discharge_count", "count", "index_encounter_id"),
            Measure("readmission_30day_count", "sum", YES_ONE.format(c="is_30_day_readmission")),
            Measure("avg_days_to_readmission", "average",
                    "case when is_30_day_readmission = 'Yes' then days_to_readmission else null end"),
        ),
        dimensions=(
            Dimension("discharge_id", "index_encounter_id"),
            Dimension("discharge_date", "to_timestamp_ntz(cast(discharge_date_key as string), 'yyyyMMdd')", "time"),
            Dimension("had_readmission", "has_readmission"),
            Dimension("readmission_window",
                      "case when is_7_day_readmission = 'Yes' then '0-7 days' "
                      "when is_30_day_readmission = 'Yes' then '8-30 days' else 'No readmission' end"),
        ),
        agg_time_dimension="discharge_date"),
    SemanticModel(
        "patients", dim_patient,
        # patient_id repeats across insurance versions, so the unique
        # entity is never used as a join key
        entities=(Entity("patient", "primary", "patient_key"), Entity("patient_member", "unique", "patient_id")),
        measures=(Measure("patient_count", "count_distinct", "patient_id"),),
        dimensions=(
            Dimension("patient_key", "patient_key"), Dimension("patient_id", "patient_id"),
            Dimension("patient_name", "concat(first_name, ' ', last_name)"),
            Dimension("gender", "patient_gender"), Dimension("race", "race"), Dimension("ethnicity", "ethnicity"),
            Dimension("insurance_period_start", "effective_from", "time"),
            Dimension("insurance_period_end", "effective_to", "time"),
            Dimension("is_current_insurance", "is_current"),
        ),
        agg_time_dimension="insurance_period_start"),
    SemanticModel(
        "providers", dim_provider,
        entities=(Entity("provider", "primary", "provider_key"),),
        dimensions=(Dimension("provider_key", "provider_key"), Dimension("provider_id", "provider_id"),
                    Dimension("provider_name", "provider_name"), Dimension("specialty", "provider_specialty"),
                    Dimension("city", "address_city"), Dimension("state", "address_state"))),
    SemanticModel(
        "payers", dim_payer,
        entities=(Entity("payer", "primary", "payer_key"),),
        dimensions=(Dimension("payer_key", "payer_key"), Dimension("payer_id", "payer_id"),
                    Dimension("payer_name", "payer_name"), Dimension("state", "address_state"))),
    SemanticModel(
        "organizations", dim_organization,
        entities=(Entity("organization", "primary", "organization_key"),),
        dimensions=(Dimension("organization_key", "organization_key"),
                    Dimension("organization_id", "organization_id"),
                    Dimension("organization_name", "organization_name"),
                    Dimension("city", "address_city"), Dimension("state", "address_state"))),
]}

METRICS: dict[str, Metric] = {m.name: m for m in [
    Metric("emergency_visits", "simple", "emergency_visit_count", label="Emergency Visits"),
    Metric("inpatient_admits", "simple", "inpatient_admission_count", label="Inpatient Admits"),
    Metric("payer_coverage_total", "simple", "total_payer_coverage", label="Payer Coverage Total"),
    Metric("patient_oop_total", "simple", "total_patient_oop", label="Patient OOP Total"),
    Metric("total_encounters", "simple", "encounter_count", label="Total Encounters"),
    Metric("avg_cost_per_encounter", "simple", "avg_encounter_cost", label="Avg Cost Per Encounter"),
    Metric("total_healthcare_cost", "simple", "total_encounter_cost", label="Total Healthcare Cost"),
    Metric("ed_utilization_rate", "ratio", numerator="emergency_visits", denominator="total_encounters",
           label="ED Utilization Rate"),
    Metric("inpatient_admission_rate", "ratio", numerator="inpatient_admits", denominator="total_encounters",
           label="Inpatient Admission Rate"),
    Metric("readmission_count", "simple", "readmission_30day_count", label="Readmission Count"),
    Metric("total_discharges", "simple", "discharge_count", label="Discharge Count"),
    Metric("readmission_rate_30day", "ratio", numerator="readmission_count", denominator="total_discharges",
           label="30-Day Readmission Rate"),
    Metric("metric_avg_days_to_readmission", "simple", "avg_days_to_readmission", label="Avg Days to Readmission"),
    Metric("patient_cost_burden", "ratio", numerator="patient_oop_total", denominator="total_healthcare_cost",
           label="Patient Cost Burden"),
    Metric("insurance_coverage_rate", "ratio", numerator="payer_coverage_total", denominator="total_healthcare_cost",
           label="Insurance Coverage Rate"),
    Metric("avg_encounter_duration", "simple", "avg_duration_hours", label="Avg Encounter Duration (hrs)"),
]}


# -- compilation ---------------------------------------------------------------
def _measure_home(measure: str) -> tuple[SemanticModel, Measure]:
    for sm in SEMANTIC_MODELS.values():
        for m in sm.measures:
            if m.name == measure:
                return sm, m
    raise KeyError(f"unknown measure {measure!r}")


def _metric_measures(metric: str) -> list[str]:
    m = METRICS[metric]
    if m.type == "simple":
        return [m.measure]
    return _metric_measures(m.numerator) + _metric_measures(m.denominator)


def _primary_model(entity: str) -> SemanticModel | None:
    return next((sm for sm in SEMANTIC_MODELS.values() if sm.primary and sm.primary.name == entity), None)


def _join_path(base: SemanticModel, entity: str, max_hops: int = 2) -> list[tuple[SemanticModel, Entity]] | None:
    """Chain of (model, foreign entity) hops from ``base`` to the model where
    ``entity`` is primary; [] when ``entity`` is ``base``'s own primary."""
    if base.primary and base.primary.name == entity:
        return []
    frontier = [(base, [])]
    for _ in range(max_hops):
        nxt = []
        for sm, path in frontier:
            for e in sm.entities:
                if e.type != "foreign":
                    continue
                target = _primary_model(e.name)
                if target is None:
                    continue
                hop = path + [(sm, e)]
                if e.name == entity:
                    return hop
                nxt.append((target, hop))
        frontier = nxt
    return None


@dataclass
class _Item:
    """A group-by or filter item of a query on one semantic model."""

    ref: str
    expr: str
    hops: tuple[tuple[SemanticModel, Entity], ...]  # entity joins that lead to it
    grain: str | None = None


def _item(base: SemanticModel, ref: str) -> _Item:
    if ref.startswith("metric_time"):
        grain = ref.split("__", 1)[1] if "__" in ref else "day"
        if grain not in GRAINS:
            raise ValueError(f"unknown time grain {grain!r}")
        return _Item(ref, base.dimension(base.agg_time_dimension).expr, (), grain)
    entity, dim_name = ref.split("__", 1)
    path = _join_path(base, entity)
    if path is None:
        raise ValueError(f"{ref!r} is not reachable from semantic model {base.name!r}")
    home = _primary_model(path[-1][1].name) if path else base
    dim = home.dimension(dim_name)
    if dim is None:
        raise ValueError(f"{home.name} has no dimension {dim_name!r}")
    return _Item(ref, dim.expr, tuple(path))


def _alias(hops: Sequence[tuple[SemanticModel, Entity]]) -> str:
    """Prefix of the columns that a chain of joins adds."""
    return "".join(f"_j_{e.name}_" for _, e in hops)


def _named(expr: str, prefix: str, columns: Sequence[str]) -> Column:
    """An expression over a model's columns, which carry ``prefix``."""
    found = re.sub(r"\b([a-z_][a-z0-9_]*)\b", lambda m: f"`{prefix}{m.group(1)}`" if f"{prefix}{m.group(1)}" in columns else m.group(1), expr)
    return F.expr(found if prefix else expr)


def _value(i: _Item, columns: Sequence[str]) -> Column:
    c = _named(i.expr, _alias(i.hops), columns)
    return F.to_date(F.date_trunc(i.grain, c)) if i.grain else c


def _join(ctx: Context, df: DataFrame, hops: Sequence[tuple[SemanticModel, Entity]], foreign_key: Column) -> DataFrame:
    """Many-to-one join of the model that the last hop leads to; its columns get the chain's prefix."""
    target, prefix = _primary_model(hops[-1][1].name), _alias(hops)
    t = ctx.ref(target.model)
    t = t.select([F.col(c).alias(f"{prefix}{c}") for c in t.columns])
    return df.join(t, foreign_key == F.col(f"{prefix}{target.primary.expr}"), "left")


class _Aggregate:
    """A measure as partial aggregates that can be added up, and its value from them.

    Sums of doubles are sums of decimals, which do not depend on the order of rows: with ten decimals for what is
    declared as money, with eighteen otherwise.  A value beyond them (or NaN) makes its group's sum one of doubles."""

    def __init__(self, m: Measure, df: DataFrame):
        n, e = m.name, F.expr(m.expr)
        self.name, self.distinct = n, e if m.agg == "count_distinct" else None
        self.parts: dict[str, Column] = {}
        if self.distinct is not None:
            self.value = F.col(n)
            return
        self.parts[f"{n}.n"] = F.count(e)
        count = F.col(f"`{n}.n`")
        self.value = count
        if m.agg == "count":
            return
        if isinstance(df.select(e).schema[0].dataType, (T.DoubleType, T.FloatType)):
            exact = e.try_cast(MONEY if m.money else WIDE)
            self.parts |= {f"{n}.s": F.sum(exact), f"{n}.d": F.sum(e), f"{n}.lost": F.count(F.when(e.isNotNull() & exact.isNull(), F.lit(1)))}
            total = F.when(F.col(f"`{n}.lost`") == 0, F.col(f"`{n}.s`").cast("double")).otherwise(F.col(f"`{n}.d`"))
        else:
            self.parts[f"{n}.s"] = F.sum(e)
            total = F.col(f"`{n}.s`")
        self.value = total if m.agg == "sum" else total.cast("double") / F.nullif(count, F.lit(0))


def _measured(ctx: Context, sm: SemanticModel, measures: Sequence[str], keys: Sequence[str], where: str | None, where_refs: Sequence[str]) -> DataFrame:
    """Measures of one semantic model by ``keys``.

    Joins to other facts come first, on the rows.  Then the rows are aggregated by the items known so far and the
    foreign keys that are still to be followed; the dimensions are joined to these few rows, and a second
    aggregation adds them up.  A hot key of a dimension is thus one row per task before any join."""
    items = [_item(sm, ref) for ref in dict.fromkeys([*keys, *where_refs])]
    df = ctx.ref(sm.model)
    joined: set[str] = set()
    late: dict[str, tuple] = {}  # dimension joins by alias: their hops
    for i in items:
        for depth in range(1, len(i.hops) + 1):
            hops = i.hops[:depth]
            if _alias(hops) in joined or _alias(hops) in late:
                continue
            if _primary_model(hops[-1][1].name).is_fact:
                df = _join(ctx, df, hops, _named(hops[-1][1].expr, _alias(hops[:-1]), df.columns))
                joined.add(_alias(hops))
            else:
                late[_alias(hops)] = hops
    early = [i for i in items if _alias(i.hops) not in late]
    aggregates = [_Aggregate(_measure_home(n)[1], ctx.ref(sm.model)) for n in measures]
    columns = df.columns
    foreign = {f"{alias}fk": _named(hops[-1][1].expr, _alias(hops[:-1]), columns) for alias, hops in late.items()}
    base = [F.col(c) for c in ctx.ref(sm.model).columns]
    df = df.select(*base, *[_value(i, columns).alias(i.ref) for i in early], *[c.alias(n) for n, c in foreign.items()])
    if where and not any(_alias(i.hops) in late for i in items if i.ref in where_refs):
        df, where = df.filter(F.expr(where)), None
    # a global aggregate gets a constant key so models align by equi-join
    final_keys = [F.col(k) for k in keys] or [F.lit(1).alias("_all")]
    distinct = [a for a in aggregates if a.distinct is not None]
    parts = {n: c for a in aggregates for n, c in a.parts.items()}

    if not late:
        out = df.groupBy(*final_keys).agg(*[c.alias(n) for n, c in parts.items()], *[F.countDistinct(a.distinct).alias(a.name) for a in distinct])
    else:
        groups = [F.col(i.ref) for i in early] + [F.col(n) for n in foreign] + [a.distinct.alias(f"{a.name}.x") for a in distinct]
        df = df.groupBy(*groups).agg(*([c.alias(n) for n, c in parts.items()] or [F.count(F.lit(1)).alias("_n")]))
        for alias, hops in late.items():
            df = _join(ctx, df, hops, F.col(f"{alias}fk"))
        columns = df.columns
        df = df.select("*", *[_value(i, columns).alias(i.ref) for i in items if i not in early])
        if where:
            df = df.filter(F.expr(where))
        out = df.groupBy(*final_keys).agg(*[F.sum(F.col(f"`{n}`")).alias(n) for n in parts],
                                          *[F.countDistinct(F.col(f"`{a.name}.x`")).alias(a.name) for a in distinct])
    return out.select(*[F.col(k) for k in keys or ["_all"]], *[a.value.alias(a.name) for a in aggregates])


def metric_query(ctx: Context, metrics: Sequence[str] = (), group_by: Sequence[str] = (), where: str | None = None,
                 order_by: Sequence[str] = (), limit: int | None = None,
                 measures: Sequence[str] = (), spine: bool = False) -> DataFrame:
    """Compute ``metrics`` (and raw ``measures``) grouped by ``group_by``.

    ``where`` is a SQL predicate over group-by item names (it is applied
    before aggregation, on every semantic model involved).  ``order_by``
    items may start with ``-`` for descending.  ``limit`` keeps the first
    rows after ordering (a top-k report).  ``spine`` returns a row for every
    period of the calendar between the first and the last one observed, for
    every observed group: periods without rows have zero counts and sums, and
    NULL averages and ratios.
    """
    needed: dict[str, list[str]] = {}
    for name in [x for m in metrics for x in _metric_measures(m)] + list(measures):
        sm, _ = _measure_home(name)
        needed.setdefault(sm.name, [])
        if name not in needed[sm.name]:
            needed[sm.name].append(name)
    where_refs = sorted(set(re.findall(r"\b(?:metric_time|[a-z]+)__[a-z_]+\b", where or "")))
    keys = list(group_by)
    parts = [_measured(ctx, SEMANTIC_MODELS[sm_name], ms, keys, where, where_refs) for sm_name, ms in needed.items()]
    keys_or_all = keys or ["_all"]
    out = parts[0]
    for p in parts[1:]:
        cond = None
        for k in keys_or_all:
            c = out[k].eqNullSafe(p[k])
            cond = c if cond is None else cond & c
        joined = out.join(p, cond, "full_outer")
        out = joined.select(*[F.coalesce(out[k], p[k]).alias(k) for k in keys_or_all],
                            *[out[c] for c in out.columns if c not in keys_or_all],
                            *[p[c] for c in p.columns if c not in keys_or_all])
    if spine:
        out = _on_spine(out, keys, needed)
    final = [F.col(k) for k in keys]
    for name in metrics:
        final.append(_metric_value(name).alias(name))
    final += [F.col(m) for m in measures if m not in metrics]
    out = out.select(*final)
    if order_by:
        out = out.orderBy(*[F.col(o[1:]).desc() if o.startswith("-") else F.col(o).asc() for o in order_by])
    if limit is not None:
        out = out.limit(limit)
    return out


def _on_spine(out: DataFrame, keys: Sequence[str], needed: dict[str, list[str]]) -> DataFrame:
    """The aligned measures on the dense time spine of their ``metric_time`` key."""
    times = [k for k in keys if k.startswith("metric_time")]
    if len(times) != 1:
        raise ValueError("a time spine needs one metric_time item among the group-by items")
    period, others = times[0], [k for k in keys if k != times[0]]
    dense = dense_series(out, period, others, period.split("__", 1)[1] if "__" in period else "day")
    zero = [n for ms in needed.values() for n in ms if _measure_home(n)[1].agg != "average"]
    return dense.select(*keys, *[F.coalesce(F.col(n), F.lit(0).cast(t)).alias(n) if n in zero else F.col(n)
                                 for n, t in dense.dtypes if n not in keys])


def _metric_value(name: str) -> Column:
    m = METRICS[name]
    if m.type == "simple":
        return F.col(m.measure)
    num, den = _metric_value(m.numerator), _metric_value(m.denominator)
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


# -- registered metric queries ---------------------------------------------------
ENCOUNTER_METRICS = ["emergency_visits", "inpatient_admits", "payer_coverage_total", "patient_oop_total",
                     "total_encounters", "avg_cost_per_encounter", "total_healthcare_cost", "ed_utilization_rate",
                     "inpatient_admission_rate", "patient_cost_burden", "insurance_coverage_rate",
                     "avg_encounter_duration"]
READMISSION_METRICS = ["readmission_count", "total_discharges", "readmission_rate_30day",
                       "metric_avg_days_to_readmission"]


def metric_encounters_by_month(ctx: Context) -> DataFrame:
    return metric_query(ctx, ENCOUNTER_METRICS, ["metric_time__month"],
                        measures=["payer_coverage_pct"])


def metric_readmissions_by_window_year(ctx: Context) -> DataFrame:
    return metric_query(ctx, READMISSION_METRICS, ["metric_time__year", "readmission__readmission_window"])


def metric_readmission_rate_by_payer_month(ctx: Context) -> DataFrame:
    """Readmissions have no payer: readmission -> encounter -> payer, two hops."""
    return metric_query(ctx, ["readmission_rate_30day", "total_discharges", "readmission_count"],
                        ["metric_time__month", "payer__payer_name"])


def metric_multi_model_by_care_setting(ctx: Context) -> DataFrame:
    """Encounter and readmission metrics aligned on the encounter's care setting."""
    return metric_query(ctx, ["total_encounters", "total_healthcare_cost", "ed_utilization_rate",
                              "total_discharges", "readmission_rate_30day"],
                        ["encounter__care_setting"])


def metric_cost_by_specialty_and_state(ctx: Context) -> DataFrame:
    return metric_query(ctx, ["total_healthcare_cost", "avg_cost_per_encounter", "total_encounters"],
                        ["provider__specialty", "organization__state"])


def metric_patients_by_gender(ctx: Context) -> DataFrame:
    return metric_query(ctx, group_by=["patient__gender", "patient__is_current_insurance"],
                        measures=["patient_count"])


def metric_inpatient_week_filtered(ctx: Context) -> DataFrame:
    return metric_query(ctx, ["total_encounters", "avg_encounter_duration", "total_healthcare_cost"],
                        ["metric_time__week", "payer__state"],
                        where="encounter__care_setting = 'inpatient'")


def metric_top_providers_by_cost(ctx: Context) -> DataFrame:
    """Top-10 provider names by total cost (the limit is the report's feature)."""
    return metric_query(ctx, ["total_healthcare_cost", "total_encounters"], ["provider__provider_name"],
                        order_by=["-total_healthcare_cost", "provider__provider_name"], limit=10)


def metric_encounters_by_day(ctx: Context) -> DataFrame:
    return metric_query(ctx, ["total_encounters", "total_healthcare_cost"], ["metric_time__day"])


def metric_cost_by_quarter(ctx: Context) -> DataFrame:
    return metric_query(ctx, ["total_healthcare_cost", "insurance_coverage_rate"], ["metric_time__quarter", "encounter__care_setting"])


def metric_readmissions_of_payer_state(ctx: Context) -> DataFrame:
    """A filter two hops away: discharges whose encounter's payer has a known state."""
    return metric_query(ctx, ["total_discharges", "readmission_rate_30day"], ["metric_time__quarter"],
                        where="payer__state IS NOT NULL AND payer__payer_name > 'B'")


def metric_inpatient_daily_series(ctx: Context) -> DataFrame:
    """Inpatient days of every payer on the calendar's spine: days without admissions are rows too."""
    return metric_query(ctx, ["total_encounters", "inpatient_admits", "total_healthcare_cost", "avg_cost_per_encounter", "ed_utilization_rate"],
                        ["metric_time__day", "payer__payer_name"], where="encounter__care_setting = 'inpatient'", spine=True)


METRIC_QUERIES = {
    "metric_encounters_by_month": metric_encounters_by_month,
    "metric_readmissions_by_window_year": metric_readmissions_by_window_year,
    "metric_readmission_rate_by_payer_month": metric_readmission_rate_by_payer_month,
    "metric_multi_model_by_care_setting": metric_multi_model_by_care_setting,
    "metric_cost_by_specialty_and_state": metric_cost_by_specialty_and_state,
    "metric_patients_by_gender": metric_patients_by_gender,
    "metric_inpatient_week_filtered": metric_inpatient_week_filtered,
    "metric_top_providers_by_cost": metric_top_providers_by_cost,
    "metric_encounters_by_day": metric_encounters_by_day,
    "metric_cost_by_quarter": metric_cost_by_quarter,
    "metric_readmissions_of_payer_state": metric_readmissions_of_payer_state,
    "metric_inpatient_daily_series": metric_inpatient_daily_series,
}
