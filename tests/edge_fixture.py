"""Hand-written raw rows that hit every edge case of the warehouse rules.

Text cleaning, bad dates, coverage periods (open, consecutive, overlapping,
two starting in one year, ending in the as-of year), encounter costs (NULL,
negative, coverage above total, total 0), durations (10:50 -> 11:10, stop
before start, > 1000 hours), readmissions (next visit at the discharge
instant, two at one later instant, exactly 7 / 30 / 90 days, none, other
organization, NULL discharge), orphans, duplicate clinical events, and
report thresholds hit exactly (rate 15 and 20, cost 50,000 and 100,000).
"""

from __future__ import annotations

import datetime as dt

from clinlake.sources.raw import RAW_SCHEMAS

LOAD = dt.datetime(2001, 12, 20, 6, 0, 0)


def _patient(pid, birth, first=None, last="Doe", gender="F", zip_="12345", state="ca", lat=10.0, loaded=LOAD):
    return dict(id=pid, birthdate=birth, first=first, last=last, gender=gender, zip=zip_, state=state, lat=lat,
                lon=-70.5, city="springfield", healthcare_expenses=1000.0, healthcare_coverage=500.0,
                _loaded_at=loaded)


def _enc(eid, pid, start, stop, cls="ambulatory", prov="S1", org="O1", payer="Y1", total=100.0, cov=50.0):
    return {"id": eid, "START": start, "STOP": stop, "patient_id": pid, "provider_id": prov, "organization_id": org,
            "payer_id": payer, "encounterclass": cls, "code": "185349003", "description": "Visit",
            "base_encounter_cost": 80.0, "total_claim_cost": total, "payer_coverage": cov, "_loaded_at": LOAD}


def raw_rows() -> dict[str, list[dict]]:
    patients = [
        _patient("P1", "1950-05-01", first="o-NEIL", last="smith", gender=" m ", zip_="123", state=" ma "),
        _patient("P2", "2020-13-01", first="  mary ann ", last="o'BRIEN", gender="f", zip_="02134-9999",
                 state="ny", lat=95.0),
        _patient("P3", "x", first="", last="doe", gender="", zip_=" ", loaded=None),
        _patient("P4", "1975-07-04", first=None, last="lee"),
    ]
    patients += [_patient(f"P{i}", "1960-01-0%d" % (i % 9 + 1), first="pat", last=f"number {i}")
                 for i in range(5, 12)]
    patients += [_patient(f"Q{i}", "1970-01-01", first="q", last=f"q{i}") for i in range(1, 21)]
    patients += [_patient(f"R{i}", "1971-01-01", first="r", last=f"r{i}") for i in range(1, 6)]
    patients += [_patient("C1", "1980-02-02", first="cost", last="fifty"),
                 _patient("C2", "1980-02-02", first="cost", last="hundred")]

    # texts that a lax parser or a greedy cleaner would get wrong
    patients += [_patient("T1", "2020-01-01 junk", first="12 main st\napt 4", last="tab\tand\rreturn"),
                 _patient("T2", "01/02/2020", first="a`b"), _patient("T3", "2-Jan-2020"), _patient("T4", "2020"),
                 _patient("T5", "2020-5"), _patient("T6", "2020-01-01Tjunk"), _patient("T7", "2020-01-02T03:04:05Z"),
                 _patient("T8", "2-Foo-2020"), _patient("T9", "13/13/2020"),
                 _patient("T10", "2020-01-01 25:99"), _patient("T11", "2020-01-01T10:00:00+25:00"),
                 _patient("T12", "2020-01-02 23:59:59.123456+05:30"), _patient("T13", "2020-01-02 7:05"),
                 _patient("T14", "2020-01-01 10:00:61"), _patient("T15", "2020-01-01T24:00:00")]

    transitions = [
        dict(patient="P1", start_year=1995, end_year=1997, payer="Y1", ownership="self"),
        dict(patient="P1", start_year=1998, end_year=1999, payer="Y2", ownership="GUARDIAN"),
        dict(patient="P1", start_year=2000, end_year=None, payer="Y1", ownership="self"),
        dict(patient="P2", start_year=1995, end_year=1998, payer="Y1", ownership="self"),
        dict(patient="P2", start_year=1997, end_year=2001, payer="Y2", ownership="spouse"),
        dict(patient="P3", start_year=1996, end_year=1996, payer="Y1", ownership=None),
        dict(patient="P3", start_year=1996, end_year=1997, payer="Y2", ownership=" "),
    ]
    for p in [f"P{i}" for i in range(5, 12)] + [f"Q{i}" for i in range(1, 21)] + \
             [f"R{i}" for i in range(1, 6)] + ["C1", "C2"]:
        transitions.append(dict(patient=p, start_year=1995, end_year=None, payer="Y1" if p[0] != "Q" else "Y2",
                                ownership="self"))

    payers = [
        dict(id="Y1", name="acme health", address="1 main st", city="boston", state_headquartered="ma", zip="02110",
             phone="(555) 000-1111", amount_covered=1000.0, amount_uncovered=10.0, revenue=5000.0,
             covered_encounters=10, uncovered_encounters=1, covered_medications=5, uncovered_medications=0,
             covered_procedures=3, uncovered_procedures=0, covered_immunizations=2, uncovered_immunizations=0,
             unique_customers=7, qols_avg=0.8, member_months=120),
        dict(id="Y2", name="beta care", address="2 elm st", city="albany", state_headquartered="NY", zip="1220",
             phone="1234 5678 9012 3456 7890", amount_covered=-5.0, amount_uncovered=0.0, revenue=100.0),
    ]
    organizations = [
        dict(id="O1", name="general hospital", address="10 hospital rd", city="boston", state="ma", zip="123",
             lat=42.3, lon=-71.1, phone="(555) 123-4567", revenue=1.0e6, utilization=100),
        dict(id="O2", name="city clinic", address="5 clinic way", city="salem", state="ma", zip="01970-1234",
             lat=42.5, lon=-70.9, phone="n/a", revenue=2.0e5, utilization=-3),
    ]
    providers = [
        dict(id="S1", organization="O1", name="dr. ann a-b", gender="f", speciality="general practice",
             address="1 a st", city="boston", state="ma", zip="02110", lat=42.0, lon=-71.0, utilization=50),
        dict(id="S2", organization="O2", name="dr. bob", gender="M", speciality="CARDIOLOGY", address="2 b st",
             city="salem", state="ma", zip="1970", lat=42.0, lon=-71.0, utilization=-1),
        dict(id="S3", organization="O1", name="dr. cy", gender="m", speciality=None, address="3 c st",
             city="boston", state="ma", zip="02110", lat=42.0, lon=-190.0, utilization=5),
    ]

    enc = [
        _enc("E1", "P1", "2000-03-05 10:50:00", "2000-03-05 11:10:00", total=100.0, cov=80.0),
        _enc("E2", "P1", "2000-03-06T09:00:00Z", "2000-03-06T08:00:00Z", cls="Wellness", total=None, cov=10.0),
        _enc("E3", "P1", "2000-04-01", "2000-06-15 00:00:00", cls="emergency", total=-50.0, cov=5.0),
        _enc("E4", "P2", "2000-05-01 12:00:00", "2000-05-01 13:00:00", cls="urgentcare", total=0.0, cov=0.0),
        _enc("E5", "P2", "2000-05-02 12:00:00", "2000-05-02 12:30:00", cls="outpatient", total=200.0, cov=250.0),
        _enc("E6", "P4", "1990-01-01 00:00:00", "1990-01-01 01:00:00", prov="S99", payer="Y9"),
        _enc("E7", "P3", "x", None, cls=None),
        _enc("E8", "P1", "2000-08-01 09:00:00", "2000-08-01 10:00:00", cls="EMERGENCY", payer=None),
        # readmission cases
        _enc("E50", "P5", "2000-01-01 08:00:00", "2000-01-03 10:00:00", cls="inpatient"),
        _enc("E51", "P5", "2000-01-03 10:00:00", "2000-01-03 11:00:00"),
        _enc("E53", "P5", "2000-01-05 09:00:00", "2000-01-05 10:00:00", org="O2"),
        _enc("E52", "P5", "2000-01-05 09:00:00", "2000-01-05 10:00:00"),
        _enc("E60", "P6", "2000-01-25 08:00:00", "2000-02-01 12:00:00", cls="inpatient"),
        _enc("E61", "P6", "2000-02-08 09:00:00", "2000-02-08 10:00:00"),
        _enc("E70", "P7", "2000-02-20 08:00:00", "2000-03-01 23:00:00", cls="Inpatient"),
        _enc("E71", "P7", "2000-03-31 01:00:00", "2000-03-31 02:00:00"),
        _enc("E80", "P8", "2000-03-25 08:00:00", "2000-04-01 10:00:00", cls="inpatient"),
        _enc("E81", "P8", "2000-06-30 10:00:00", "2000-06-30 11:00:00"),
        _enc("E90", "P9", "2000-05-01 08:00:00", "2000-05-03 08:00:00", cls="inpatient"),
        _enc("E100", "P10", "2000-06-25 08:00:00", "2000-07-01 10:00:00", cls="inpatient", org="O1"),
        _enc("E101", "P10", "2000-07-03 10:00:00", "2000-07-03 11:00:00", org="O2"),
        _enc("E110", "P11", "2000-07-05 08:00:00", None, cls="inpatient"),
        # costs exactly 50,000 and 100,000 in one fiscal year
        _enc("EC1", "C1", "2000-02-01 09:00:00", "2000-02-01 10:00:00", total=50000.0, cov=1000.0),
        _enc("EC2", "C2", "2000-03-01 09:00:00", "2000-03-01 10:00:00", total=60000.0, cov=1000.0),
        _enc("EC3", "C2", "2000-03-02 09:00:00", "2000-03-02 10:00:00", total=40000.0, cov=1000.0),
    ]
    # 20 discharges in September 2000, 3 of them readmitted within 30 days: rate exactly 15
    for i in range(1, 21):
        enc.append(_enc(f"QE{i}", f"Q{i}", "2000-09-01 08:00:00", "2000-09-10 08:00:00", cls="inpatient",
                        prov="S2", org="O2", payer="Y2", total=1000.0, cov=900.0))
    for i in range(1, 4):
        enc.append(_enc(f"QR{i}", f"Q{i}", "2000-09-20 08:00:00", "2000-09-20 09:00:00", prov="S2", org="O2",
                        payer="Y2", total=1000.0, cov=900.0))
    # provider S3: 5 discharges, 1 readmitted: rate exactly 20
    for i in range(1, 6):
        enc.append(_enc(f"RE{i}", f"R{i}", "2000-10-01 08:00:00", "2000-10-05 08:00:00", cls="inpatient",
                        prov="S3"))
    enc.append(_enc("RR1", "R1", "2000-10-15 08:00:00", "2000-10-15 09:00:00"))

    conditions = [
        {"START": "2000-03-05 10:50:00", "STOP": None, "patient_id": "P1", "encounter_id": "E1", "code": "C1",
         "description": "Hypertension", "_loaded_at": LOAD},
        {"START": "2000-03-05 10:50:00", "STOP": "2000-04-01", "patient_id": "P1", "encounter_id": "E1",
         "code": "C1", "description": "hypertension (copy)", "_loaded_at": LOAD},
        {"START": "2000-04-01", "STOP": None, "patient_id": "P1", "encounter_id": "E3", "code": "C2",
         "description": "Diabetes", "_loaded_at": None},
        {"START": "2000-04-01", "STOP": None, "patient_id": "P1", "encounter_id": "E3", "code": "C3",
         "description": "Asthma", "_loaded_at": None},
        {"START": "2000-01-01 08:00:00", "STOP": None, "patient_id": "P5", "encounter_id": "E50", "code": "C2",
         "description": "Diabetes", "_loaded_at": LOAD},
        {"START": "2000-01-02T00:00:00Z", "STOP": None, "patient_id": "P5", "encounter_id": "E50", "code": "C4",
         "description": "Copd", "_loaded_at": LOAD},
        {"START": "2000-01-25", "STOP": "2000-01-30", "patient_id": "P6", "encounter_id": "E60", "code": "C5",
         "description": "Flu", "_loaded_at": LOAD},
    ]
    medications = [
        {"START": "2000-03-05 11:00:00", "STOP": "2000-03-01 00:00:00", "patient_id": "P1", "payer_id": "Y1",
         "encounter_id": "E1", "code": "M1", "description": "Statin", "base_cost": 10.0, "dispenses": 3,
         "total_cost": 30.0, "reasoncode": None, "reasondescription": None, "payer_coverage": 20.0,
         "_loaded_at": LOAD},
        {"START": "2000-05-01T12:00:00Z", "STOP": None, "patient_id": "P2", "payer_id": "Y2", "encounter_id": "E4",
         "code": "M2", "description": "Inhaler", "base_cost": -5.0, "dispenses": 3, "total_cost": -15.0,
         "reasoncode": "C3", "reasondescription": "Asthma", "payer_coverage": 0.0, "_loaded_at": LOAD},
    ]
    procedures = [
        {"DATE": "2000-03-05 10:55:00", "patient": "P1", "encounter": "E1", "code": "X1", "description": "Ekg",
         "base_cost": 75.0, "reasoncode": "C1", "reasondescription": "Hypertension", "_loaded_at": LOAD},
        {"DATE": "x", "patient": "P2", "encounter": "E5", "code": "X2", "description": "Xray", "base_cost": -1.0,
         "_loaded_at": LOAD},
    ]
    return {"patients": patients, "encounters": enc, "conditions": conditions, "medications": medications,
            "procedures": procedures, "providers": providers, "organizations": organizations, "payers": payers,
            "payer_transitions": transitions}


def raw_frames(spark) -> dict:
    out = {}
    for name, rows in raw_rows().items():
        schema = RAW_SCHEMAS[name]
        tuples = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
        out[name] = spark.createDataFrame(tuples, schema)
    return out
