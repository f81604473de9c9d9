"""Every registered query on the hand-written edge fixture, against the oracle,
plus hand-checked values for each edge case."""
import collections
import datetime as dt
import math
import tempfile

import duckdb
import pytest

import __spark_entry__ as E
from clinlake.context import Context
from clinlake.oracle import sql as O
from clinlake.plans import catalog, intermediate, marts, reports, staging
from edge_fixture import raw_frames

# queries whose oracle reads the benchmark tables directly are the only exclusions
RAW = [n for n in O.CTES if n.startswith("raw_")]


@pytest.fixture(scope="module")
def fx(spark):
    return fixture_of(raw_frames(spark))


def fixture_of(frames):
    root = tempfile.mkdtemp(prefix="clinlake-edge-")
    con = duckdb.connect()
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")
        con.execute(f"CREATE VIEW raw_{name} AS SELECT * FROM read_parquet('{root}/{name}/*.parquet')")
    with O.external(RAW):
        oracles = catalog.oracles()
    return frames, con, oracles


_CONTEXTS = {}


def ctx_of(spark, frames):
    """One context for all tests: models are defined, and the suite's tables written, once."""
    return _CONTEXTS.setdefault(id(frames), Context(spark, dict(frames)))


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.MODELS))
def test_query_matches_oracle_on_edges(spark, fx, name):
    frames, con, oracles = fx
    df = catalog.MODELS[name](ctx_of(spark, frames))
    cur = con.execute(oracles[name])
    o_cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(o_cols)
    assert _bag(df.columns, df.collect()) == _bag(o_cols, cur.fetchall())


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_cleaning_edges(spark, fx):
    p = by(staging.stg_patients(ctx_of(spark, fx[0])), "patient_id")
    assert (p["P1"].first_name, p["P1"].last_name, p["P1"].patient_gender) == ("O-Neil", "Smith", "M")
    assert (p["P2"].first_name, p["P2"].last_name) == ("Mary Ann", "O'brien")
    assert p["P3"].first_name is None and p["P3"].patient_gender is None and p["P4"].first_name is None
    assert [p[k].home_address_postal_code for k in ("P1", "P2", "P3")] == ["00123", "02134", None]
    assert p["P2"].birth_date is None and p["P3"].birth_date is None
    assert p["P3"].loaded_at == dt.datetime(2002, 1, 1)
    o = by(staging.stg_organizations(ctx_of(spark, fx[0])), "organization_id")
    assert (o["O1"].organization_phone_number, o["O2"].organization_phone_number) == (5551234567, None)
    y = by(staging.stg_payers(ctx_of(spark, fx[0])), "payer_id")
    assert y["Y2"].payer_phone_number == 12345678901234567890
    assert (p["T1"].first_name, p["T1"].last_name) == ("12 Main St\nApt 4", "Tab\tAnd\rReturn")
    assert p["T2"].first_name == "A`b"
    day = dt.date(2020, 1, 2)
    assert [p[f"T{i}"].birth_date for i in range(1, 10)] == [None, day, day, None, None, None, day, None, None]
    assert [p[f"T{i}"].birth_date for i in range(10, 16)] == [None, None, day, day, None, None]


def test_encounter_edges(spark, fx):
    ctx = ctx_of(spark, fx[0])
    e = by(intermediate.int_encounter_enriched(ctx), "encounter_id")
    assert e["E1"].duration_hours == 1
    assert e["E4"].payer_coverage_pct is None and e["E5"].care_setting == "other"
    assert e["E6"].provider_id is None and e["E6"].payer_id is None
    f = by(marts.fct_encounters(ctx), "encounter_id")
    assert f["E2"].duration_hours == 0 and f["E3"].duration_hours is None
    assert f["E2"].total_claim_cost is None and f["E3"].total_claim_cost == 0.0
    assert f["E6"].patient_key == "b99834bc19bbad24580b3adfa04fb947"
    assert "E7" in f and f["E7"].encounter_start_time is None


def test_readmission_edges(spark, fx):
    r = by(intermediate.int_readmission_flags(ctx_of(spark, fx[0])), "index_encounter_id")
    assert "E110" not in r
    assert (r["E50"].readmit_encounter_id, r["E50"].days_to_readmission) == ("E52", 2)
    assert (r["E60"].days_to_readmission, r["E60"].is_7_day_readmission) == (7, "Yes")
    assert (r["E70"].days_to_readmission, r["E70"].is_7_day_readmission, r["E70"].is_30_day_readmission) == \
        (30, "No", "Yes")
    assert (r["E80"].days_to_readmission, r["E80"].is_30_day_readmission, r["E80"].is_90_day_readmission) == \
        (90, "No", "Yes")
    assert (r["E90"].has_readmission, r["E90"].readmit_encounter_id) == ("No", None)
    assert (r["E100"].has_readmission, r["E100"].is_same_organization_readmission) == ("Yes", "No")


def test_report_thresholds(spark, fx):
    ctx = ctx_of(spark, fx[0])
    rr = {(r.year_month, r.payer_name): r for r in reports.rpt_readmission_rate_monthly(ctx).collect()}
    sep = rr[("2000-09", "Beta Care")]
    assert (sep.discharge_count, sep.readmission_30day_count, sep.readmission_30day_rate_pct, sep.quality_flag) == \
        (20, 3, 15.0, "OK")
    assert rr[("2000-10", "Acme Health")].quality_flag == "Alert"
    pp = by(reports.rpt_provider_performance(ctx), "provider_id")
    assert (pp["S3"].readmission_30day_rate_pct, pp["S3"].quality_flag) == (20.0, "Low Volume")
    cc = {(r.patient_id, r.fiscal_year): r.cost_category for r in reports.rpt_cost_of_care_annual(ctx).collect()}
    assert cc[("C1", 2000)] == "Low Cost" and cc[("C2", 2000)] == "Medium Cost"
    me = {(r.year_month, r.payer_name) for r in reports.rpt_monthly_encounters(ctx).collect()}
    assert ("2000-08", "Unknown") in me


def test_duplicate_event_kept_once(spark, fx):
    ev = marts.fct_clinical_events(ctx_of(spark, fx[0])).filter("clinical_code = 'C1'").collect()
    assert len(ev) == 1 and ev[0].clinical_description == "Hypertension"


def test_repeated_dimension_rows_do_not_repeat_counts(spark):
    """A provider and an organization that stand twice in their tables: one row per provider, ids counted once."""
    frames = raw_frames(spark)
    single = {r.provider_id: r.total_encounters for r in reports.rpt_provider_performance(Context(spark, dict(frames))).collect()}
    frames["providers"] = frames["providers"].unionAll(frames["providers"])
    frames["organizations"] = frames["organizations"].unionAll(frames["organizations"].filter("id = 'O2'"))
    _, con, oracles = fixture_of(frames)
    df = reports.rpt_provider_performance(Context(spark, dict(frames)))
    cur = con.execute(oracles["rpt_provider_performance"])
    assert _bag(df.columns, df.collect()) == _bag([d[0] for d in cur.description], cur.fetchall())
    got = by(df, "provider_id")
    assert {k: r.total_encounters for k, r in got.items()} == single == {"S1": 25, "S2": 23, "S3": 5}
    # sums follow the source's joins, where a discharge of a twice listed provider meets itself four times
    assert df.count() == 3 and got["S3"].inpatient_discharges == 5 and got["S3"].readmission_30day_count == 4
    assert (got["S3"].readmission_30day_rate_pct, got["S3"].quality_flag) == (80.0, "High Risk (Readmission)")
