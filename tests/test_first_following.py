"""First-following-event operator: edge cases and brute force on random data."""
import datetime as dt
import random

from pyspark.sql import functions as F

from clinlake.operators.first_following import first_following

T0 = dt.datetime(2001, 1, 1, 12, 0)


def run(spark, anchors, cands, bucket="DAY"):
    a = spark.createDataFrame(anchors, "aid string, pid string, t timestamp_ntz")
    c = spark.createDataFrame(cands, "cid string, pid string, s timestamp_ntz, org string")
    out = first_following(a, c, "pid", "t", "s", ["cid"], ["org"], bucket=bucket)
    return {r.aid: (r.match.cid if r.match else None) for r in out.collect()}


def brute(anchors, cands):
    res = {}
    for aid, pid, t in anchors:
        best = None
        for cid, cp, s, _ in cands:
            if cp == pid and t is not None and s is not None and s > t:
                if best is None or (s, cid) < best:
                    best = (s, cid)
        res[aid] = best[1] if best else None
    return res


def test_edge_cases(spark):
    h = dt.timedelta(hours=1)
    anchors = [("a1", "p1", T0), ("a2", "p2", T0), ("a3", "p3", T0), ("a4", "p4", T0)]
    cands = [
        ("e0", "p1", T0, "o"),             # same instant: not counted
        ("e2", "p1", T0 + h, "o"),         # two at the same later instant:
        ("e1", "p1", T0 + h, "o"),         #   lowest id wins
        ("e9", "p2", T0 + dt.timedelta(days=30), "x"),  # next bucket, far away
        ("e8", "p2", T0 + dt.timedelta(days=90), "x"),
        ("e7", "p3", T0 - h, "x"),         # before: none
    ]
    assert run(spark, anchors, cands) == {"a1": "e1", "a2": "e9", "a3": None, "a4": None}


def test_matches_brute_force_with_a_hot_entity(spark):
    rnd = random.Random(7)
    base = dt.datetime(2000, 1, 1)
    cands, anchors = [], []
    for i in range(3000):
        pid = "hot" if i % 3 == 0 else f"p{rnd.randrange(60)}"
        s = base + dt.timedelta(hours=rnd.randrange(24 * 200))
        cands.append((f"e{rnd.randrange(2000):04d}", pid, s, f"o{rnd.randrange(3)}"))
    for i in range(900):
        pid = "hot" if i % 3 == 0 else f"p{rnd.randrange(60)}"
        t = base + dt.timedelta(hours=rnd.randrange(24 * 200))
        if i % 10 == 0:  # anchors exactly at a candidate instant
            t = rnd.choice(cands)[2]
            pid = [c for c in cands if c[2] == t][0][1]
        anchors.append((f"a{i}", pid, t))
    # copies: one encounter repeated many times at one instant, and
    # discharges repeated at one instant
    hot_t = base + dt.timedelta(hours=500)
    cands += [(f"e{k % 3}", "hot", hot_t, "o9") for k in range(300)]
    anchors += [(f"c{k}", "hot", hot_t - dt.timedelta(minutes=1)) for k in range(50)]
    anchors += [(f"d{k}", "hot", hot_t) for k in range(50)]
    want = brute(anchors, cands)
    for bucket in ("DAY", "HOUR", "MONTH"):
        assert run(spark, anchors, cands, bucket) == want


def test_hot_entity_is_spread_over_partitions(spark):
    """A patient holding over a third of all rows must not land in one task:
    the windows partition by (patient, hour bucket), so its rows spread."""
    import collections

    from pyspark.sql import Window

    base = dt.datetime(2000, 1, 1)
    cands = [(f"e{i}", "hot" if i % 2 == 0 else f"p{i % 97}", base + dt.timedelta(minutes=37 * i), "o")
             for i in range(6000)]
    c = spark.createDataFrame(cands, "cid string, pid string, s timestamp_ntz, org string")
    # the partitioning the in-bucket window requires: hash of (entity, bucket)
    rows = (c.select(F.col("pid").alias("_k"), F.date_trunc("HOUR", "s").alias("_b"))
            .repartition(16, "_k", "_b")
            .withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("_k", "_b")))
            .select("_k", F.spark_partition_id().alias("part")))
    hot_parts = collections.Counter(r.part for r in rows.filter("_k = 'hot'").collect())
    assert len(hot_parts) >= 12                       # spread over most partitions
    assert max(hot_parts.values()) < 3000 / 4         # no partition holds a quarter of the hot rows


def test_nulls_never_match_and_anchors_are_kept(spark):
    h = dt.timedelta(hours=1)
    anchors = [("a1", None, T0), ("a2", "p", None), ("a3", "p", T0), ("a3", "p", T0)]   # a copy of a3 too
    cands = [("e1", None, T0 + h, "o"), ("e2", "p", None, "o"), ("e3", "p", T0 + 2 * h, "o")]
    a = spark.createDataFrame(anchors, "aid string, pid string, t timestamp_ntz")
    c = spark.createDataFrame(cands, "cid string, pid string, s timestamp_ntz, org string")
    out = first_following(a, c, "pid", "t", "s", ["cid"], ["org"]).collect()
    assert len(out) == 4   # every anchor row comes back, copies included
    got = sorted((r.aid, r.match.cid if r.match else None) for r in out)
    assert got == [("a1", None), ("a2", None), ("a3", "e3"), ("a3", "e3")]


def test_null_tie_break_comes_last(spark):
    a = spark.createDataFrame([("P", dt.datetime(2001, 1, 1))], "k string, t timestamp_ntz")
    c = spark.createDataFrame([("P", dt.datetime(2001, 1, 2), None, "x"), ("P", dt.datetime(2001, 1, 2), "E9", "y")],
                              "k string, s timestamp_ntz, e string, o string")
    row = first_following(a, c, "k", "t", "s", ["e"], ["o"]).first()
    assert (row.match.e, row.match.o) == ("E9", "y")
