"""Calendar dimension: row count and every attribute against the DuckDB oracle."""
import duckdb

from clinlake.context import Context
from clinlake.oracle import sql as O
from clinlake.plans.marts import dim_date


def test_dim_date_matches_oracle(spark):
    ctx = Context(spark, {})
    got = dim_date(ctx)
    assert got.count() == 47847
    rows = {tuple(r) for r in got.collect()}
    con = duckdb.connect()
    want = {tuple(r) for r in con.execute(O.model("dim_date")).fetchall()}
    assert rows == want
