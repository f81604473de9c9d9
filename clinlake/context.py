"""Model context: the session, the raw tables and the run's fixed clock.

Models are plain functions ``model(ctx) -> DataFrame``.  ``ctx.ref(model)``
builds a model once per context and hands back the same DataFrame object
to every consumer, so a plan that reads one upstream model twice contains
two identical subtrees that Catalyst can reuse (ReusedExchange) instead of
recomputing.
"""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from collections import Counter
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Fixed clock used by tests and the oracle comparison.
DEFAULT_AS_OF = dt.date(2001, 12, 31)
DEFAULT_RUN_TS = dt.datetime(2002, 1, 1, 0, 0, 0)


def kept(spark: SparkSession) -> dict:
    """What is defined once per session; it goes with the session object."""
    return spark.__dict__.setdefault("_clinlake", {})


def _state(spark: SparkSession, folder: str) -> list:
    """Names, sizes and times of a folder's files (two levels deep): whether it still is what plans were made of."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for s in fs.listStatus(path):
        inner = fs.listStatus(s.getPath()) if s.isDirectory() else [s]
        found += [(x.getPath().toString(), x.getLen(), x.getModificationTime()) for x in inner]
    return sorted(found)


def _current(spark: SparkSession, kind: str, folder: str, more: tuple, make: Callable[[], object]):
    """``make()``, kept per session and folder until the folder's files change."""
    key, state = (kind, spark.sparkContext.applicationId, folder, more), _state(spark, folder)
    notes = kept(spark)
    if key not in notes or notes[key][0] != state:
        notes[key] = state, make()
    return notes[key][1]


def _put(df: DataFrame, path: str) -> None:
    """A table of the session's own folder (zstd: keys of hex digits take half of what they take in snappy)."""
    df.write.option("compression", "zstd").parquet(path)


@dataclass
class Context:
    spark: SparkSession
    raw: dict[str, DataFrame]
    as_of: dt.date = DEFAULT_AS_OF
    run_ts: dt.datetime = DEFAULT_RUN_TS
    checkpoint_models: bool = False
    _models: dict = field(default_factory=dict, repr=False)
    _materialized: set = field(default_factory=set, repr=False)
    _locks: dict = field(default_factory=dict, repr=False)
    _guard: threading.Lock = field(default_factory=threading.Lock, repr=False)
    _path: list = field(default_factory=list, repr=False)
    _warehouse: list = field(default_factory=list, repr=False)
    _observed: dict = field(default_factory=dict, repr=False)
    rejected: dict[str, DataFrame] = field(default_factory=dict, repr=False)  # malformed raw rows by table
    read_by: dict[str, list[str]] = field(default_factory=dict, repr=False)  # what each model asked for
    _building: threading.local = field(default_factory=threading.local, repr=False)

    @classmethod
    def from_bench(cls, spark: SparkSession, sf_dir: str, **kw) -> Context:
        """Context over the benchmark tables in ``sf_dir``.

        The bound raw DataFrames are lazy plans; they are built once per
        session and directory (like registering source views once) and
        every query still scans the files when it runs.
        """
        from clinlake.sources.binding import bind_raw

        return cls(spark, dict(_current(spark, "raw", sf_dir, (), lambda: bind_raw(spark, sf_dir))), **kw)

    @classmethod
    def shared(cls, spark: SparkSession, sf_dir: str, **kw) -> Context:
        """One context per session, benchmark folder, state of its files and clock.

        Its models are lazy plans, defined once and reused by every query of
        the session (each query still executes its whole plan from the
        files).  What the quality suite wrote and found is kept with it, as
        long as the folder's files are the same.
        """
        return _current(spark, "context", sf_dir, tuple(sorted(kw.items())), lambda: cls.from_bench(spark, sf_dir, **kw))

    @classmethod
    def from_raw(cls, spark: SparkSession, root: str, fmt: str = "parquet", **kw) -> Context:
        from clinlake.sources.raw import load_raw, rejected_rows

        return cls(spark, load_raw(spark, root, fmt), rejected=rejected_rows(spark, root, fmt), **kw)

    # -- clock ---------------------------------------------------------
    def as_of_col(self) -> Column:
        return F.lit(self.as_of.isoformat()).cast("date")

    def run_ts_col(self) -> Column:
        return F.to_timestamp_ntz(F.lit(self.run_ts.strftime("%Y-%m-%d %H:%M:%S")))

    # -- lineage -------------------------------------------------------
    def ref(self, model: Callable[[Context], DataFrame]) -> DataFrame:
        key = model.__name__
        self._note(key)
        if key in self._models:
            return self._models[key]
        with self._guard:
            lock = self._locks.setdefault(key, threading.Lock())
        with lock:  # one builder per model, even when models build concurrently
            if key not in self._models:
                df = self.recorded(key, model)
                if self.checkpoint_models and not getattr(model, "keep_lazy", False):
                    # a Parquet table in the shared checkpoint folder: the
                    # model is computed once, and later plans scan only the
                    # columns they use.  Models marked keep_lazy (projections
                    # of a source or of such a table, single aggregations
                    # over facts) stay lazy: recomputing them from what is
                    # already cut is cheaper than writing and re-reading a copy.
                    path = f"{self._folder()}/{key}"
                    parts = self.recorded(key, model.parts) if hasattr(model, "parts") else [df]
                    paths = [f"{path}/{i}" for i in range(len(parts))]
                    df = self.observed_write(key, df, lambda d, i: _put(d, paths[i]),
                                             lambda schema: self.spark.read.schema(schema).parquet(*paths), parts)
                    self._materialized.add(key)
                self._models[key] = df
        return self._models[key]

    def _note(self, name: str) -> None:
        """The model being defined reads ``name``."""
        if stack := getattr(self._building, "stack", None):
            self.read_by.setdefault(stack[-1], []).append(name)

    def recorded(self, name: str, model: Callable[[Context], DataFrame]) -> DataFrame:
        """``model(self)``, with what it reads noted under ``name``."""
        stack = self._building.__dict__.setdefault("stack", [])
        stack.append(name)
        try:
            return model(self)
        finally:
            stack.pop()

    def observed_write(self, name: str, df: DataFrame, write: Callable[[DataFrame, int], None], read: Callable,
                       parts: Sequence[DataFrame] = ()) -> DataFrame:
        """Write a model, let the write count what its row-level tests ask for, and return the written table.

        ``parts`` (default: the whole) together are the model; they are written one after the other, so that only one's
        shuffle files are on disk at a time.
        A task that runs again after an executor is lost can count its rows twice, so the counts only hold if
        their number of rows is that of the table (read from the files' footers); otherwise tests scan it."""
        from clinlake.plans.quality import ROWS, row_metrics
        from clinlake.session import short_lived_shuffles

        metrics = Counter()
        for i, part in enumerate(parts or [df]):
            seen = Observation()
            with short_lived_shuffles(self.spark):
                write(part.observe(seen, *row_metrics(name)), i)
            metrics.update(seen.get)
        table = read(df.schema)
        with short_lived_shuffles(self.spark):
            if metrics[ROWS] == table.count():
                self._observed[name] = metrics
        return table

    def observed(self, name: str) -> dict | None:
        """Counts that the write of a model collected (None: none, or none that hold)."""
        return self._observed.get(name)

    def _folder(self) -> str:
        """This context's folder of materialized models."""
        from clinlake.session import ensure_checkpoint_dir

        with self._guard:
            if not self._path:
                self._path.append(f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/models-{uuid.uuid4().hex}")
            return self._path[0]

    def build_levels(self, levels: Sequence[Sequence[Callable[[Context], DataFrame]]], threads: int = 4) -> None:
        """Build models level by level; models of one level (independent of
        each other) are submitted as concurrent Spark jobs from ``threads``
        driver threads."""
        with ThreadPoolExecutor(max_workers=threads) as pool:
            for level in levels:
                list(pool.map(self.ref, level))

    def materialized(self) -> Context:
        """A context whose models are written to the shared folder when first used.

        Used by consumers that read many models at once (the quality
        suite): each model is computed once and every test scans the columns
        it needs of its table, instead of one plan re-deriving the whole
        lineage per test.  Models already materialized (or read back from
        written tables) are kept; lazy ones are rebuilt and written.
        """
        if self.checkpoint_models:
            return self
        kept = {k: v for k, v in self._models.items() if k in self._materialized}
        return Context(self.spark, self.raw, self.as_of, self.run_ts, True, kept, set(kept),
                       _observed=dict(self._observed), rejected=self.rejected)

    def once(self, name: str, build: Callable[[Context], DataFrame]) -> DataFrame:
        """``build(ctx)`` computed once for this context: a table in its folder."""
        from clinlake.session import short_lived_shuffles

        if name not in self._models:
            path = f"{self._folder()}/{name}"
            df = build(self)
            with short_lived_shuffles(self.spark):
                _put(df, path)
            self._models[name] = self.spark.read.schema(df.schema).parquet(path)
        return self._models[name]

    def use_table(self, model: Callable[[Context], DataFrame], df: DataFrame) -> None:
        """Downstream models read ``df`` (a written table) for ``model``."""
        self._models[model.__name__] = df
        self._materialized.add(model.__name__)

    def materialize_warehouse(self, threads: int = 1) -> Context:
        """Materialized context with every intermediate, mart and report model
        written.  It is made once per context, so the suite's queries of a
        session share the tables.  One model is written at a time, as the driver
        holds the plans, metrics and broadcasts of all that are being written;
        ``threads`` driver threads write independent ones concurrently."""
        from clinlake.plans.lineage import build_levels

        if not self._warehouse:
            ctx = self.materialized()
            ctx.build_levels(build_levels(self.spark, self), threads)
            ctx._warehouse[:] = [ctx]
            self._warehouse[:] = [ctx]
        return self._warehouse[0]

    def source(self, name: str) -> DataFrame:
        self._note(f"source_{name}")
        return self.raw[name]
