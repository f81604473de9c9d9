"""Table sinks: full rebuilds that readers see at once, and the append-only audit log.

A build writes its tables to a folder of its own, ``{root}/builds/{build}``, and
becomes the current one when its name is put in the pointer file
``{root}/CURRENT``: one rename of a small file, after all tables are written.
Readers resolve the pointer, so they see the whole old build until then and the
whole new one afterwards; a build that fails is never pointed to.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

POINTER = "CURRENT"


def _path(spark: SparkSession, path: str):
    """Hadoop path and its file system (whatever store the scheme names)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def new_build() -> str:
    return uuid.uuid4().hex


def current_build(spark: SparkSession, root: str) -> str | None:
    """The build that readers of ``root`` see (None before the first one)."""
    path, fs = _path(spark, f"{root.rstrip('/')}/{POINTER}")
    if not fs.exists(path):
        return None
    reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(fs.open(path), "UTF-8"))
    try:
        return reader.readLine()
    finally:
        reader.close()


def publish(spark: SparkSession, root: str, build: str) -> None:
    """Make ``build`` the current one: the pointer is written beside and renamed over the old one."""
    root = root.rstrip("/")
    draft, fs = _path(spark, f"{root}/.{POINTER}-{build}")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(build, "utf-8"))
    finally:
        out.close()
    target, _ = _path(spark, f"{root}/{POINTER}")
    files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri() if target.toUri().getScheme() else fs.getUri(),
                                                                      spark._jsc.hadoopConfiguration())
    option = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(option, 1)
    options[0] = option.OVERWRITE
    files.rename(fs.makeQualified(draft), fs.makeQualified(target), options)


def drop_old_builds(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete all builds but the newest ``keep`` and the current one; returns their names.  Readers that still hold
    tables of a deleted build lose them, so this is for a quiet time, and never called by a build."""
    folder, fs = _path(spark, f"{root.rstrip('/')}/builds")
    if not fs.exists(folder):
        return []
    found = sorted(((s.getModificationTime(), s.getPath()) for s in fs.listStatus(folder)), key=lambda x: -x[0])
    old = [p for _, p in found[keep:] if p.getName() != current_build(spark, root)]
    for p in old:
        fs.delete(p, True)
    return [p.getName() for p in old]


def table_path(root: str, layer: str, model: str, build: str) -> str:
    """Layer routing: a build's model lands in ``{root}/builds/{build}/{layer}/{model}``."""
    return f"{root.rstrip('/')}/builds/{build}/{layer}/{model}"


def write_table(df: DataFrame, root: str, layer: str, model: str, build: str, partition_by: Sequence[str] = ()) -> str:
    """One model of a build as a Parquet table; returns its path.

    The write is the materialization boundary: downstream models read the
    written table, so a lost executor only recomputes from the last table,
    not from the raw sources.
    """
    path = table_path(root, layer, model, build)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_table(spark: SparkSession, root: str, layer: str, model: str, build: str | None = None) -> DataFrame:
    """A table of a build (the current one, unless another is named)."""
    build = build or current_build(spark, root)
    if build is None:
        raise FileNotFoundError(f"no build has been published under {root}")
    return spark.read.parquet(table_path(root, layer, model, build))


def write_bucketed_table(df: DataFrame, root: str, layer: str, model: str, build: str, database: str,
                         bucket_by: Sequence[str], buckets: int) -> str:
    """One model of a build as a bucketed Parquet table registered in the
    catalog (data at the layer path).

    Tables bucketed on the same key with the same bucket count join and
    aggregate on that key without a shuffle; readers must go through the
    catalog (``spark.table``) so the bucketing is known to the planner.
    Rows are first dealt out by the bucket key, so each task writes one
    bucket: the number of files is the number of buckets, not tasks times buckets.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root.rstrip('/')}/_catalog/{database}'")
    path = table_path(root, layer, model, build)
    (df.repartition(buckets, *bucket_by).write.mode("overwrite").bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
     .option("path", path).saveAsTable(f"{database}.{model}"))
    return path


RUN = "_run"


def put_rows(df: DataFrame, path: str, run: str) -> None:
    """Put the rows of one run in a Parquet table that may gain columns over time, exactly once.

    A run is one partition, replaced as a whole when Spark commits the write: a run that is repeated after a
    failure, or by mistake, leaves its rows once, and other runs' rows are not touched."""
    from pyspark.sql import functions as F

    (df.withColumn(RUN, F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(RUN).parquet(path))


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """Read a table of runs whose files have different column sets
    (missing columns read as NULL)."""
    return spark.read.option("mergeSchema", "true").parquet(path).drop(RUN)
