"""Recorded lineage: which models each model and check reads, in the order it asks for them.

Models are defined once per session (plans only, no job), on empty raw tables where no context has them;
``Context.ref`` and ``Context.source`` note who reads what.  Build levels and
the dependencies of audit rows follow from these notes, so no list of them is
kept by hand.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clinlake.context import Context, kept
from clinlake.plans import intermediate, marts, quality, reports
from clinlake.sources.raw import RAW_SCHEMAS

#: Models that the suite writes; others stay lazy (see ``keep_lazy``).
WRITTEN: dict[str, Callable[[Context], DataFrame]] = {
    **intermediate.INTERMEDIATE_MODELS, **{n: f for n, f in marts.MART_MODELS.items() if not hasattr(f, "keep_lazy")},
    "distinct_clinical_events": marts.distinct_clinical_events, **reports.REPORT_MODELS}


def reads(spark: SparkSession, ctx: Context | None = None) -> dict[str, tuple[str, ...]]:
    """What each model and singular check reads itself; sources are named ``source_<table>``.

    Lazy models of ``ctx`` are used, where one is given (they are defined once, and serve its queries as well)."""
    notes, key = kept(spark), ("lineage", spark.sparkContext.applicationId)
    if key not in notes:
        if ctx is None or ctx.checkpoint_models or set(ctx.raw) != set(RAW_SCHEMAS):
            ctx = Context(spark, {t: spark.createDataFrame([], schema) for t, schema in RAW_SCHEMAS.items()})
        for fn in quality.model_functions().values():
            ctx.ref(fn)
        for name, (_, fn) in quality.SINGULAR.items():
            ctx.recorded(name, fn)
        notes[key] = {name: tuple(dict.fromkeys(found)) for name, found in ctx.read_by.items()}
    return notes[key]


def build_levels(spark: SparkSession, ctx: Context | None = None) -> list[list[Callable[[Context], DataFrame]]]:
    """Written models by level: those of one level read, directly or through lazy models, written models of earlier
    levels only, so they can be built concurrently.  A model marked written_late comes after all that can do without it:
    its large table is not yet on disk beside the others' shuffle files."""
    known = reads(spark, ctx)
    depth: dict[str, int] = {}

    def waits(name: str) -> bool:
        return hasattr(WRITTEN.get(name), "written_late") or any(waits(r) for r in known.get(name, ()))

    def level(name: str) -> int:
        if name not in depth:
            below = max((level(r) for r in known.get(name, ())), default=-1)
            depth[name] = below + (name in WRITTEN)
        return depth[name]

    levels: dict[tuple[bool, int], list] = {}
    for name, fn in WRITTEN.items():
        levels.setdefault((waits(name), level(name)), []).append(fn)
    return [levels[i] for i in sorted(levels)]
