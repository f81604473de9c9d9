"""Build the warehouse: ``python -m clinlake --raw ROOT --out OUT`` (or ``--bench SF_DIR``).

Writes marts and reports under ``OUT/{layer}/{model}``, runs the quality
suite and appends its results to ``OUT/audit/test_results``.  On a cluster
submit it with spark-submit; ``spark.checkpoint.dir`` must name a shared
folder.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from clinlake.context import Context
from clinlake.plans import warehouse
from clinlake.session import build_session


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="clinlake")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--raw", help="folder with the nine raw tables, one sub-folder each")
    src.add_argument("--bench", help="folder with the benchmark parquet tables (bound to the raw tables)")
    ap.add_argument("--format", default="parquet", choices=["parquet", "csv"], help="format of --raw")
    ap.add_argument("--out", required=True, help="warehouse root")
    ap.add_argument("--as-of", type=dt.date.fromisoformat, default=dt.date.today())
    ap.add_argument("--master", default=None, help="e.g. local[8]; omit under spark-submit")
    ap.add_argument("--threads", type=int, default=4, help="models built concurrently per level")
    ap.add_argument("--profile", default="cluster", choices=["local", "cluster"], help="session sizing profile")
    ap.add_argument("--no-tests", action="store_true")
    a = ap.parse_args(argv)

    spark = build_session(a.master, profile="local" if (a.master or "").startswith("local") else a.profile)
    kw = dict(as_of=a.as_of, run_ts=dt.datetime.now().replace(microsecond=0))
    ctx = (Context.from_raw(spark, a.raw, a.format, **kw) if a.raw else Context.from_bench(spark, a.bench, **kw))
    print(json.dumps(warehouse.run(ctx, a.out, with_tests=not a.no_tests, threads=a.threads), default=str))


if __name__ == "__main__":
    main()
