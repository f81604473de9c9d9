"""Binding of the benchmark tables to the nine raw healthcare tables.

The benchmark ships TPC-H-like tables, not patient extracts.  This module
derives the raw tables from them with plain projections, so the work of
every model grows with the benchmark data:

* patients          <- customer
* encounters        <- orders (one encounter per order)
* conditions        <- lineitem with return flag R, joined to orders for the patient
* medications       <- lineitem with return flag A, joined to orders
* procedures        <- lineitem with return flag N, joined to orders
* providers         <- supplier
* organizations     <- nation
* payers            <- region
* payer_transitions <- customer, three coverage periods each (explode, no cross join)

Raw dates are rendered as text in several formats (plain, ISO with ``Z``,
date only) with a few unparseable values, names and codes arrive in mixed
case with blanks, and some foreign keys point nowhere, so every cleaning
rule and every orphan path of the warehouse is exercised.  The same
binding is written as DuckDB SQL in :mod:`clinlake.oracle.sql`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.sources.raw import conform

BENCH_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

FULL = "yyyy-MM-dd HH:mm:ss"
ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"
DAY = "yyyy-MM-dd"


def read_bench(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in BENCH_TABLES}


def _s(c: Column) -> Column:
    return c.cast("string")


def _txt(ts: Column, fmt: str) -> Column:
    return F.date_format(ts, fmt)


def _hours(ts: Column, h: Column) -> Column:
    return ts + F.make_dt_interval(F.lit(0), h.cast("int"), F.lit(0), F.lit(0))


def _minutes(ts: Column, m: Column) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), m.cast("int"), F.lit(0))


def _days(ts: Column, d: Column) -> Column:
    return ts + F.make_dt_interval(d.cast("int"), F.lit(0), F.lit(0), F.lit(0))


def _none() -> Column:
    return F.lit(None).cast("string")


def bind_patients(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    birth = F.concat(_s(1930 + k % 60), F.lit("-"), F.lpad(_s(1 + k % 12), 2, "0"), F.lit("-"),
                     F.lpad(_s(1 + k % 28), 2, "0"))
    base_ts = F.to_timestamp_ntz(F.lit("2001-09-01 00:00:00"))
    df = customer.select(
        F.concat(F.lit("P"), _s(k)).alias("id"),
        F.when(k % 97 == 5, "x").when(k % 89 == 3, "2020-13-01").otherwise(birth).alias("birthdate"),
        F.when(k % 17 == 0, "2001-06-30").alias("deathdate"),
        F.concat(F.lit("999-"), F.lpad(_s(k % 100), 2, "0"), F.lit("-"), F.lpad(_s(k % 10000), 4, "0")).alias("ssn"),
        F.when(k % 5 == 0, " ").otherwise(F.concat(F.lit("S"), _s(k * 7 % 100000))).alias("drivers"),
        F.when(k % 4 == 0, _none()).otherwise(F.concat(F.lit("X"), _s(k), F.lit("X"))).alias("passport"),
        F.when(k % 3 == 0, "mr.").when(k % 3 == 1, "MRS.").alias("prefix"),
        F.when(k % 11 == 0, "  mary ann ").when(k % 13 == 0, "o-NEIL").when(k % 19 == 0, "")
         .otherwise(F.col("c_mktsegment")).alias("first"),
        F.col("c_name").alias("last"),
        F.when(k % 7 == 0, "jr").alias("suffix"),
        _none().alias("maiden"),
        F.when(k % 3 == 0, "M").when(k % 3 == 1, "s").alias("marital"),
        F.lower("c_mktsegment").alias("race"),
        F.when(k % 2 == 0, "hispanic").otherwise("nonhispanic").alias("ethnicity"),
        F.when(k % 37 == 0, _none()).when(k % 2 == 0, " m ").otherwise("f").alias("gender"),
        F.concat(F.lit("nation_"), _s(F.col("c_nationkey")), F.lit(" city")).alias("birthplace"),
        F.concat(_s(k), F.lit(" main ST")).alias("address"),
        F.concat(F.lit("NATION_"), _s(F.col("c_nationkey"))).alias("city"),
        F.concat(F.lit("county of nation "), _s(F.col("c_nationkey"))).alias("county"),
        F.when(k % 3 == 0, " ma ").when(k % 3 == 1, "ny").otherwise("").alias("state"),
        F.when(k % 4 == 0, "02134-9999").when(k % 4 == 1, "123").when(k % 4 == 2, " ")
         .otherwise(F.lpad(_s(k % 100000), 5, "0")).alias("zip"),
        ((k % 200 - 100).cast("double") + F.lit(0.5)).alias("lat"),
        ((k % 360 - 180).cast("double") + F.lit(0.25)).alias("lon"),
        F.col("c_acctbal").alias("healthcare_expenses"),
        (F.col("c_acctbal") / 2).alias("healthcare_coverage"),
        F.when(k % 10 == 0, F.lit(None))
         .otherwise(base_ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (k % 86400).cast("int")))
         .alias("_loaded_at"),
    )
    return conform(df, "patients")


def bind_encounters(orders: DataFrame, n_supp: Column, n_nat: Column, n_reg: Column) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    ts0 = _minutes(_hours(F.col("o_orderdate"), k % 24), k * 7 % 60)
    ts1 = _hours(_minutes(_hours(ts0, k * 7 % 121 - 2), k % 50), F.when(k % 997 == 0, 1500).otherwise(0))
    total = F.col("o_totalprice") / 100
    prio = F.substring("o_orderpriority", 1, 1)
    enc_class = (F.when(k % 41 == 0, "home")
                 .when(prio == "1", "emergency")
                 .when(prio == "2", F.when(k % 4 == 0, "Inpatient").otherwise("inpatient"))
                 .when(prio == "3", "ambulatory")
                 .when(prio == "4", "urgentcare")
                 .otherwise("WELLNESS"))
    df = orders.select(
        F.concat(F.lit("E"), _s(k)).alias("id"),
        F.when(k % 500 == 7, "x").when(k % 10 == 1, _txt(ts0, ISO)).when(k % 10 == 2, _txt(ts0, DAY))
         .otherwise(_txt(ts0, FULL)).alias("START"),
        F.when(k % 53 == 0, _none()).when(k % 10 == 1, _txt(ts1, ISO)).otherwise(_txt(ts1, FULL)).alias("STOP"),
        F.concat(F.lit("P"), _s(c)).alias("patient_id"),
        F.concat(F.lit("S"), _s(k % (n_supp + 1))).alias("provider_id"),
        F.concat(F.lit("O"), _s(c % (n_nat + 1))).alias("organization_id"),
        F.when(k % 29 == 0, _none()).otherwise(F.concat(F.lit("Y"), _s((k + c) % (n_reg + 1)))).alias("payer_id"),
        enc_class.alias("encounterclass"),
        _s(k % 1000).alias("code"),
        F.concat(F.col("o_orderstatus"), F.lit(" visit")).alias("description"),
        (F.col("o_totalprice") / 10).alias("base_encounter_cost"),
        F.when(k % 83 == 0, F.lit(None)).when(k % 89 == 0, -total).when(k % 97 == 0, F.lit(0.0))
         .otherwise(total).alias("total_claim_cost"),
        F.when(k % 31 == 0, F.lit(None)).otherwise(total - (k % 12 - 1).cast("double") * 10)
         .alias("payer_coverage"),
        F.when(k % 3 == 0, _none()).otherwise(_s(k % 500)).alias("reasoncode"),
        F.when(k % 3 == 0, _none()).otherwise(F.concat(F.lit("reason "), _s(k % 500))).alias("reasondescription"),
        F.when(k % 10 == 0, F.lit(None)).otherwise(_days(F.col("o_orderdate"), F.lit(30))).alias("_loaded_at"),
    )
    return conform(df, "encounters")


def _lines(lineitem: DataFrame, orders: DataFrame, flag: str) -> DataFrame:
    li = lineitem.filter(F.col("l_returnflag") == flag)
    o = orders.select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner")


def bind_conditions(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    ln, pk = F.col("l_linenumber"), F.col("l_partkey")
    t0 = _hours(F.col("l_shipdate"), ln)
    df = _lines(lineitem, orders, "R").select(
        F.when(ln % 3 == 0, _txt(F.col("l_shipdate"), DAY)).when(ln % 3 == 1, _txt(t0, ISO))
         .otherwise(_txt(t0, FULL)).alias("START"),
        F.when(F.col("l_linestatus") == "O", _none())
         .otherwise(_txt(_days(t0, F.col("l_quantity")), FULL)).alias("STOP"),
        F.concat(F.lit("P"), _s(F.col("o_custkey"))).alias("patient_id"),
        F.concat(F.lit("E"), _s(F.col("l_orderkey"))).alias("encounter_id"),
        _s(pk % 100).alias("code"),
        F.concat(F.lit("Condition "), _s(pk % 100)).alias("description"),
        F.when(ln == 1, F.lit(None)).otherwise(F.col("l_shipdate")).alias("_loaded_at"),
    )
    return conform(df, "conditions")


def bind_medications(lineitem: DataFrame, orders: DataFrame, n_reg: Column) -> DataFrame:
    ln, pk = F.col("l_linenumber"), F.col("l_partkey")
    t0 = _hours(F.col("l_shipdate"), ln)
    base = F.col("l_extendedprice") / 100
    df = _lines(lineitem, orders, "A").select(
        F.when(ln % 2 == 1, _txt(t0, ISO)).otherwise(_txt(t0, FULL)).alias("START"),
        F.when(ln == 7, _none()).otherwise(_txt(_days(t0, ln - 2), FULL)).alias("STOP"),
        F.concat(F.lit("P"), _s(F.col("o_custkey"))).alias("patient_id"),
        F.concat(F.lit("Y"), _s(F.col("l_orderkey") % n_reg)).alias("payer_id"),
        F.concat(F.lit("E"), _s(F.col("l_orderkey"))).alias("encounter_id"),
        _s(pk % 300).alias("code"),
        F.concat(F.lit("Medication "), _s(pk % 300)).alias("description"),
        base.alias("base_cost"),
        F.col("l_quantity").cast("bigint").alias("dispenses"),
        (base * F.col("l_quantity")).alias("total_cost"),
        F.when(ln % 2 == 0, _none()).otherwise(_s(pk % 50)).alias("reasoncode"),
        F.when(ln % 2 == 0, _none()).otherwise(F.concat(F.lit("indication "), _s(pk % 50))).alias("reasondescription"),
        (base * F.col("l_quantity") * F.col("l_discount")).alias("payer_coverage"),
        F.col("l_shipdate").alias("_loaded_at"),
    )
    return conform(df, "medications")


def bind_procedures(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    ln, pk = F.col("l_linenumber"), F.col("l_partkey")
    t0 = _hours(F.col("l_shipdate"), ln)
    base = F.col("l_extendedprice") / 100
    df = _lines(lineitem, orders, "N").select(
        F.when(ln % 2 == 0, _txt(t0, ISO)).otherwise(_txt(t0, FULL)).alias("DATE"),
        F.concat(F.lit("P"), _s(F.col("o_custkey"))).alias("patient"),
        F.concat(F.lit("E"), _s(F.col("l_orderkey"))).alias("encounter"),
        _s(pk % 250).alias("code"),
        F.concat(F.lit("Procedure "), _s(pk % 250)).alias("description"),
        F.when(ln == 7, -base).otherwise(base).alias("base_cost"),
        F.when(ln % 3 == 0, _none()).otherwise(_s(pk % 40)).alias("reasoncode"),
        F.when(ln % 3 == 0, _none()).otherwise(F.concat(F.lit("finding "), _s(pk % 40))).alias("reasondescription"),
        F.col("l_shipdate").alias("_loaded_at"),
    )
    return conform(df, "procedures")


def bind_providers(supplier: DataFrame) -> DataFrame:
    k = F.col("s_suppkey")
    df = supplier.select(
        F.concat(F.lit("S"), _s(k)).alias("id"),
        F.concat(F.lit("O"), _s(F.col("s_nationkey"))).alias("organization"),
        F.lower("s_name").alias("name"),
        F.when(k % 2 == 0, "m").otherwise("F").alias("gender"),
        F.when(k % 4 == 0, "general practice").when(k % 4 == 1, "CARDIOLOGY")
         .when(k % 4 == 2, "internal-medicine").alias("speciality"),
        F.concat(_s(k), F.lit(" elm street")).alias("address"),
        F.concat(F.lit("city "), _s(k % 10)).alias("city"),
        F.lit("ca").alias("state"),
        F.when(k % 5 == 0, "123").otherwise(F.lpad(_s(k), 5, "0")).alias("zip"),
        (k % 90).cast("double").alias("lat"),
        (-(k % 180).cast("double")).alias("lon"),
        (k * 37 % 1000 - 5).cast("bigint").alias("utilization"),
        F.lit(None).alias("_loaded_at"),
    )
    return conform(df, "providers")


def bind_organizations(nation: DataFrame) -> DataFrame:
    k = F.col("n_nationkey")
    df = nation.select(
        F.concat(F.lit("O"), _s(k)).alias("id"),
        F.concat(F.lower("n_name"), F.lit(" general hospital")).alias("name"),
        F.concat(_s(k), F.lit(" hospital rd")).alias("address"),
        F.lower("n_name").alias("city"),
        F.lit("tx").alias("state"),
        F.when(k % 3 == 0, "123").otherwise(F.concat(F.lit("7"), F.lpad(_s(k), 4, "0"), F.lit("-0001"))).alias("zip"),
        k.cast("double").alias("lat"),
        (-k.cast("double")).alias("lon"),
        F.when(k % 7 == 0, "n/a").otherwise(F.concat(F.lit("(555) 123-"), F.lpad(_s(k), 4, "0"))).alias("phone"),
        (k.cast("double") * F.lit(1000.5)).alias("revenue"),
        (k * 10).cast("bigint").alias("utilization"),
        F.lit(None).alias("_loaded_at"),
    )
    return conform(df, "organizations")


def bind_payers(region: DataFrame) -> DataFrame:
    k = F.col("r_regionkey")
    kd = k.cast("double")
    df = region.select(
        F.concat(F.lit("Y"), _s(k)).alias("id"),
        F.concat(F.col("r_name"), F.lit(" health plan")).alias("name"),
        F.concat(_s(k), F.lit(" insurance way")).alias("address"),
        F.lower("r_name").alias("city"),
        F.lit("ma").alias("state_headquartered"),
        F.lpad(_s(k), 5, "0").alias("zip"),
        F.concat(F.lit("555-010-"), _s(k)).alias("phone"),
        (kd * F.lit(100000.0)).alias("amount_covered"),
        (kd * F.lit(5000.0) - F.lit(10000.0)).alias("amount_uncovered"),
        (kd * F.lit(250000.0)).alias("revenue"),
        (k * 100).alias("covered_encounters"), (k * 10).alias("uncovered_encounters"),
        (k * 50).alias("covered_medications"), (k * 5).alias("uncovered_medications"),
        (k * 30).alias("covered_procedures"), (k * 3).alias("uncovered_procedures"),
        (k * 20).alias("covered_immunizations"), (k * 2).alias("uncovered_immunizations"),
        (k * 1000).alias("unique_customers"),
        (kd / F.lit(10.0)).alias("qols_avg"),
        (k * 12000).alias("member_months"),
        F.lit(None).alias("_loaded_at"),
    )
    return conform(df, "payers")


def bind_payer_transitions(customer: DataFrame, n_reg: Column) -> DataFrame:
    k = F.col("c_custkey")
    j = F.col("j")
    periods = customer.select("c_custkey", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("j"))
    df = periods.select(
        F.concat(F.lit("P"), _s(k)).alias("patient"),
        F.when((j == 1) & (k % 50 == 0), F.lit(1995)).otherwise(1995 + 2 * j).alias("start_year"),
        F.when((j == 2) & (k % 3 == 0), F.lit(None))
         .otherwise(1996 + 2 * j + F.when(k % 10 == 0, 1).otherwise(0)).alias("end_year"),
        F.concat(F.lit("Y"), _s((k + j) % n_reg)).alias("payer"),
        F.when(j == 0, "guardian").when(j == 1, "SELF").otherwise("spouse").alias("ownership"),
        F.lit(None).alias("_loaded_at"),
    )
    return conform(df, "payer_transitions")


def bind_raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The nine raw tables derived from the benchmark tables in ``sf_dir``."""
    b = read_bench(spark, sf_dir)
    # table sizes used to spread foreign keys: one metadata-only count each
    # (parquet footers), done once per binding and folded in as constants
    n_supp = F.lit(b["supplier"].count())
    n_nat = F.lit(b["nation"].count())
    n_reg = F.lit(b["region"].count())
    return {
        "patients": bind_patients(b["customer"]),
        "encounters": bind_encounters(b["orders"], n_supp, n_nat, n_reg),
        "conditions": bind_conditions(b["lineitem"], b["orders"]),
        "medications": bind_medications(b["lineitem"], b["orders"], n_reg),
        "procedures": bind_procedures(b["lineitem"], b["orders"]),
        "providers": bind_providers(b["supplier"]),
        "organizations": bind_organizations(b["nation"]),
        "payers": bind_payers(b["region"]),
        "payer_transitions": bind_payer_transitions(b["customer"], n_reg),
    }
