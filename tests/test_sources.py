"""Raw loaders: parquet and csv extracts give the same warehouse as the binding."""
import collections
import tempfile

import pytest

from clinlake.context import Context
from clinlake.plans import reports, staging
from clinlake.sources.raw import RAW_SCHEMAS, write_raw
from conftest import SF_SMALL


def bag(df):
    return collections.Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_round_trip_through_raw_extracts(spark, fmt):
    bound = Context.from_bench(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix=f"clinlake-raw-{fmt}-")
    write_raw(bound.raw, root, fmt)
    loaded = Context.from_raw(spark, root, fmt)
    for name, schema in RAW_SCHEMAS.items():
        assert loaded.raw[name].schema == schema
    assert bag(staging.stg_patients(loaded)) == bag(staging.stg_patients(bound))
    assert bag(reports.rpt_high_risk_patients(loaded)) == bag(reports.rpt_high_risk_patients(bound))


def test_damaged_csv_rows_are_found(spark, tmp_path):
    """A number that is none, a missing cell and a cell too many are rejected with their lines; good rows stay as they are."""
    import glob

    from clinlake.context import Context
    from clinlake.plans import quality
    from clinlake.sources.raw import quarantine, write_raw
    from clinlake.sources.sinks import read_evolving
    from conftest import SF_SMALL

    good = Context.from_bench(spark, SF_SMALL)
    write_raw(good.raw, str(tmp_path), "csv")
    want = {t: sorted(map(repr, df.collect())) for t, df in Context.from_raw(spark, str(tmp_path), "csv").raw.items()}
    path = glob.glob(f"{tmp_path}/payers/part-*.csv")[0]
    with open(path) as f:
        header, line = f.read().splitlines()[:2]
    cells = line.split(",")
    path = f"{tmp_path}/payers/damaged.csv"
    with open(path, "w") as f:
        f.write("\n".join([header, ",".join([*cells[:7], "12x", *cells[8:]]), ",".join(cells[:5]), line + ",extra"]) + "\n")
    ctx = Context.from_raw(spark, str(tmp_path), "csv")
    assert {t: sorted(map(repr, df.collect())) for t, df in ctx.raw.items()} == want
    assert ctx.raw["payers"].select("name").count() == len(want["payers"])  # whatever columns are read
    profile = {r.table_name: (r.total_rows, r.rejected_rows) for r in quality.dq_load_profile(ctx).collect()}
    assert profile["payers"] == (len(want["payers"]), 3) and profile["patients"] == (len(want["patients"]), 0)
    for _ in range(2):
        quarantine(spark, str(tmp_path), f"{tmp_path}/quarantine", "load-1")
    kept = read_evolving(spark, f"{tmp_path}/quarantine").collect()
    assert len(kept) == 3 and {r.table_name for r in kept} == {"payers"} and any("12x" in r.record for r in kept)
    assert all(r.file.endswith(path.rpartition("/")[2]) for r in kept)


def test_freshness_of_files(spark, tmp_path):
    import datetime as dt
    import glob
    import os

    from clinlake.context import Context
    from clinlake.sources.raw import file_freshness, write_raw
    from conftest import SF_SMALL

    write_raw(Context.from_bench(spark, SF_SMALL).raw, str(tmp_path))
    ages = {"patients": 3, "payers": 31, "providers": 46}
    for path in glob.glob(f"{tmp_path}/*/part-*"):
        age = ages.get(path.split("/")[-2], 0)
        at = dt.datetime(2001, 12, 31, 12, tzinfo=dt.timezone.utc) - dt.timedelta(days=age)
        os.utime(path, (at.timestamp(), at.timestamp()))
    got = {r.table_name: (r.age_days, r.freshness_status) for r in file_freshness(spark, str(tmp_path), dt.date(2001, 12, 31)).collect()}
    assert got["patients"] == (3, "pass") and got["payers"] == (31, "warn") and got["providers"] == (46, "error")
    assert got["encounters"] == (0, "pass") and len(got) == 9
