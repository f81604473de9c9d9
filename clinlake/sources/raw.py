"""Raw source tables: declared schemas and loaders.

The nine raw tables arrive as text-heavy extracts (dates and timestamps are
text, parsed safely in staging).  Every read declares its schema, so no
inference pass runs over the data, and column pruning / filter pushdown
reach the Parquet scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinlake.sources.sinks import put_rows

S, D, L, TS = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampNTZType()


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols] + [T.StructField("_loaded_at", TS, True)])


RAW_SCHEMAS: dict[str, T.StructType] = {
    "patients": _schema(
        ("id", S), ("birthdate", S), ("deathdate", S), ("ssn", S), ("drivers", S), ("passport", S),
        ("prefix", S), ("first", S), ("last", S), ("suffix", S), ("maiden", S), ("marital", S),
        ("race", S), ("ethnicity", S), ("gender", S), ("birthplace", S), ("address", S), ("city", S),
        ("county", S), ("state", S), ("zip", S), ("lat", D), ("lon", D),
        ("healthcare_expenses", D), ("healthcare_coverage", D)),
    "encounters": _schema(
        ("id", S), ("START", S), ("STOP", S), ("patient_id", S), ("provider_id", S),
        ("organization_id", S), ("payer_id", S), ("encounterclass", S), ("code", S), ("description", S),
        ("base_encounter_cost", D), ("total_claim_cost", D), ("payer_coverage", D),
        ("reasoncode", S), ("reasondescription", S)),
    "conditions": _schema(
        ("START", S), ("STOP", S), ("patient_id", S), ("encounter_id", S), ("code", S), ("description", S)),
    "medications": _schema(
        ("START", S), ("STOP", S), ("patient_id", S), ("payer_id", S), ("encounter_id", S), ("code", S),
        ("description", S), ("base_cost", D), ("dispenses", L), ("total_cost", D), ("reasoncode", S),
        ("reasondescription", S), ("payer_coverage", D)),
    "procedures": _schema(
        ("DATE", S), ("patient", S), ("encounter", S), ("code", S), ("description", S), ("base_cost", D),
        ("reasoncode", S), ("reasondescription", S)),
    "providers": _schema(
        ("id", S), ("organization", S), ("name", S), ("gender", S), ("speciality", S), ("address", S),
        ("city", S), ("state", S), ("zip", S), ("lat", D), ("lon", D), ("utilization", L)),
    "organizations": _schema(
        ("id", S), ("name", S), ("address", S), ("city", S), ("state", S), ("zip", S), ("lat", D),
        ("lon", D), ("phone", S), ("revenue", D), ("utilization", L)),
    "payers": _schema(
        ("id", S), ("name", S), ("address", S), ("city", S), ("state_headquartered", S), ("zip", S),
        ("phone", S), ("amount_covered", D), ("amount_uncovered", D), ("revenue", D),
        ("covered_encounters", L), ("uncovered_encounters", L), ("covered_medications", L),
        ("uncovered_medications", L), ("covered_procedures", L), ("uncovered_procedures", L),
        ("covered_immunizations", L), ("uncovered_immunizations", L), ("unique_customers", L),
        ("qols_avg", D), ("member_months", L)),
    "payer_transitions": _schema(
        ("patient", S), ("start_year", L), ("end_year", L), ("payer", S), ("ownership", S)),
}

RAW_TABLES = tuple(RAW_SCHEMAS)


def conform(df: DataFrame, name: str) -> DataFrame:
    """Project a DataFrame onto the declared raw schema (names, order, types)."""
    schema = RAW_SCHEMAS[name]
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


CORRUPT = "_corrupt_record"


def _read(spark: SparkSession, root: str, name: str, fmt: str) -> DataFrame:
    schema, path = RAW_SCHEMAS[name], f"{root}/{name}"
    if fmt == "csv":
        # a cell that is no number (or a row of another width) leaves the whole line in the corrupt-record column
        marked = T.StructType([*schema.fields, T.StructField(CORRUPT, S, True)])
        return spark.read.schema(marked).options(**CSV_OPTIONS, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT).csv(path)
    return spark.read.schema(schema).format(fmt).load(path)


def _parsed(name: str) -> Column:
    """True, but asks for all columns: Spark parses only those that are asked for, and whether a row is good must not
    depend on what a query reads."""
    return F.pmod(F.xxhash64(*[f.name for f in RAW_SCHEMAS[name].fields]), F.lit(2)) < 2


def load_raw(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Read the nine raw tables from ``{root}/{table}`` with declared schemas.

    ``fmt`` is ``parquet`` or ``csv`` (header row, text cells cast to the
    declared types).  Malformed rows of text files are left out here and found
    in :func:`rejected_rows`.
    """
    out = {name: _read(spark, root, name, fmt) for name in RAW_TABLES}
    return {name: df.filter(_parsed(name) & F.col(CORRUPT).isNull()).drop(CORRUPT) if CORRUPT in df.columns else df for name, df in out.items()}


def rejected_rows(spark: SparkSession, root: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """Malformed rows of each raw text table: ``table_name``, ``file`` and the ``record`` as it stands there."""
    if fmt != "csv":
        return {}
    return {name: _read(spark, root, name, fmt).filter(_parsed(name) & F.col(CORRUPT).isNotNull()).select(
        F.lit(name).alias("table_name"), F.col("_metadata.file_path").alias("file"), F.col(CORRUPT).alias("record"))
        for name in RAW_TABLES}


def quarantine(spark: SparkSession, root: str, path: str, run: str, fmt: str = "csv") -> None:
    """Put a load's malformed rows in the quarantine table at ``path`` (once per run)."""
    found = None
    for df in rejected_rows(spark, root, fmt).values():
        found = df if found is None else found.unionAll(df)
    if found is not None:
        put_rows(found, path, run)


def file_freshness(spark: SparkSession, root: str, as_of: dt.date, fmt: str = "parquet", warn_days: int = 30, error_days: int = 45) -> DataFrame:
    """Per raw table the time of its newest file and its age: freshness without a load column.

    Reads file metadata only (no data column); a table without rows has no time and is an error."""
    parts = None
    for name in RAW_TABLES:
        newest = (spark.read.schema(RAW_SCHEMAS[name]).format(fmt).load(f"{root}/{name}")
                  .agg(F.max("_metadata.file_modification_time").alias("newest_file")).select(F.lit(name).alias("table_name"), "newest_file"))
        parts = newest if parts is None else parts.unionAll(newest)
    age = F.datediff(F.lit(as_of.isoformat()).cast("date"), F.to_date("newest_file"))
    status = F.when(F.col("newest_file").isNull() | (age > error_days), "error").when(age > warn_days, "warn").otherwise("pass")
    return parts.select("table_name", "newest_file", age.alias("age_days"), status.alias("freshness_status"))


# text cells keep their blanks (cleaning them is the staging layer's job)
CSV_OPTIONS = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_raw(raw: dict[str, DataFrame], root: str, fmt: str = "parquet") -> None:
    """Export raw tables to ``{root}/{table}`` (parquet or csv), e.g. to stage
    extracts for :func:`load_raw`."""
    for name, df in raw.items():
        w = conform(df, name).write.mode("overwrite")
        if fmt == "csv":
            w.options(**CSV_OPTIONS).csv(f"{root}/{name}")
        else:
            w.format(fmt).save(f"{root}/{name}")
