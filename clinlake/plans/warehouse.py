"""End-to-end build: marts and reports written as tables, then the quality
suite and the audit log.

Staging and intermediate models stay lazy views; dimensions, facts and
reports are written (full rebuild) to a build folder under ``out``, which
readers see when it is complete, and every downstream model reads the written
table.  Those writes are the lineage
cuts: after an executor loss Spark recomputes from the last table, and the
report plans are small scans of facts instead of the whole lineage.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid

from pyspark.sql import DataFrame

from clinlake.context import Context
from clinlake.plans import audit, marts, quality, reports
from clinlake.sources import sinks
from clinlake.sources.sinks import new_build, read_table, write_bucketed_table, write_table

from concurrent.futures import ThreadPoolExecutor  # noqa: E402

# (layer, models) in dependency order; models of one entry are independent
# and are written concurrently
LEVELS = [
    ("marts", {"dim_date": marts.dim_date, "dim_patient": marts.dim_patient, "dim_provider": marts.dim_provider,
               "dim_organization": marts.dim_organization, "dim_payer": marts.dim_payer}),
    ("marts", {n: marts.MART_MODELS[n] for n in ("fct_encounters", "fct_readmissions", "fct_clinical_events")}),
    ("reporting", reports.REPORT_MODELS),
]


# Facts are bucketed on the key they are joined and grouped by downstream:
# readmissions meet their index encounter on the encounter id, and the
# primary diagnosis is a top-1 of clinical events per encounter key.
FACT_BUCKETS = {
    "fct_encounters": ["encounter_id"],
    "fct_readmissions": ["index_encounter_id"],
    "fct_clinical_events": ["encounter_key"],
}


BUCKET_BYTES = 256 << 20
LEAST_BUCKETS = 8


def bucket_count(ctx: Context) -> int:
    """Buckets of about BUCKET_BYTES for the bytes that the raw tables' scans read."""
    size, seen = 0, set()
    for df in ctx.raw.values():
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        for i in range(leaves.size()):
            leaf = leaves.apply(i)
            if (name := leaf.simpleString(1000)) not in seen:
                seen.add(name)
                size += int(str(leaf.stats().sizeInBytes()))
    return max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))


def build(ctx: Context, out: str, models: list[str] | None = None, database: str | None = None,
          buckets: int | None = None, threads: int = 4, publish: bool = True) -> dict[str, str]:
    """Write marts and reports in dependency order; returns model -> path.

    The tables go to a new build folder, which becomes the current one when all
    are written (:mod:`clinlake.sources.sinks`); with ``publish=False`` the
    caller does that.  ``buckets`` (default: from the size of the raw tables)
    is the bucket count of the fact tables; all facts share it so their joins
    on the bucket keys are shuffle-free.  ``database`` (default: named after
    ``out`` and the build) holds their catalog entries, so every build keeps
    its own.  Independent models of one level are written as concurrent Spark
    jobs from ``threads`` driver threads.
    """
    spark = ctx.spark
    buckets = buckets or bucket_count(ctx)
    name_of_build = new_build()
    database = database or fact_database(out, name_of_build)
    paths = {}

    def write(layer, name, fn):
        def to_table(df, _):
            if name in FACT_BUCKETS:
                paths[name] = write_bucketed_table(df, out, layer, name, name_of_build, database, FACT_BUCKETS[name], buckets)
            else:
                paths[name] = write_table(df, out, layer, name, name_of_build)

        def written(_):
            return spark.table(f"{database}.{name}") if name in FACT_BUCKETS else read_table(spark, out, layer, name, name_of_build)

        ctx.use_table(fn, ctx.observed_write(name, ctx.ref(fn), to_table, written))  # downstream models read the written table

    with ThreadPoolExecutor(max_workers=threads) as pool:
        for layer, fns in LEVELS:
            todo = [(layer, n, fn) for n, fn in fns.items() if models is None or n in models]
            list(pool.map(lambda a: write(*a), todo))
    if publish:
        sinks.publish(spark, out, name_of_build)
    return paths


def create_views(ctx: Context) -> list[str]:
    """A temporary view per source table and model, by its name, so that SQL can read them; returns the names.

    Lazy models stay lazy: a view is a plan.  Models that were written are read from their tables."""
    views = {f"source_{t}": df for t, df in ctx.raw.items()} | {n: ctx.ref(fn) for n, fn in quality.model_functions().items()}
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)


def fact_database(out: str, build: str) -> str:
    """Catalog database of a build's bucketed facts."""
    return "clinlake_" + hashlib.md5(f"{out.rstrip('/')}/{build}".encode()).hexdigest()[:12]


def run_tests(ctx: Context, audit_path: str | None = None, invocation_id: str | None = None) -> DataFrame:
    """Run the declared and the singular tests, in an action for each set of keys or check; put the invocation's rows in the audit log (once)."""
    started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    results = quality.column_test_results(ctx).checkpoint(eager=True).unionByName(quality.singular_results(ctx).checkpoint(eager=True))
    if audit_path:
        invocation_id = invocation_id or str(uuid.uuid4())
        rows = audit.audit_rows(results, invocation_id, started,
                                dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0))
        audit.log_test_results(rows, audit_path, invocation_id)
    return results


def run(ctx: Context, out: str, with_tests: bool = True, threads: int = 4) -> dict:
    paths = build(ctx, out, threads=threads)
    summary = {"tables": paths}
    if with_tests:
        res = run_tests(ctx.materialized(), audit_path=f"{out.rstrip('/')}/audit/test_results")
        summary["tests"] = {r["status"]: r["n"] for r in res.groupBy("status").count()
                            .withColumnRenamed("count", "n").collect()}
    return summary
