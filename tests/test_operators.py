"""top1 and the point-in-time join."""
import datetime as dt

from clinlake.operators.point_in_time import point_in_time_join
from clinlake.operators.ranking import top1

D = dt.date


def test_top1_orders_and_breaks_ties_deterministically(spark):
    df = spark.createDataFrame([("k", D(2001, 1, 1), 1, "b"), ("k", D(2001, 1, 1), 2, "a"),
                                ("k", None, 9, "z"), ("j", D(1999, 1, 1), 1, "x")],
                               "k string, d date, v int, s string")
    # desc nulls first: the NULL date wins for k
    got = {r.k: (r.d, r.v) for r in top1(df, ["k"], [("d", "desc", "first"), ("v", "desc", "first")]).collect()}
    assert got == {"k": (None, 9), "j": (D(1999, 1, 1), 1)}
    got = {r.k: r.v for r in top1(df, ["k"], [("d", "desc", "last"), ("v", "desc", "first")]).collect()}
    assert got["k"] == 2
    # copies collapse to one row, chosen by the remaining values
    dup = spark.createDataFrame([("c", "b"), ("c", "a"), ("c", "a")], "k string, s string")
    assert [r.s for r in top1(dup, ["k"], []).collect()] == ["a"]


def test_top1_shuffles_ascending_sort_fields_once(spark):
    """Values that order the rows are no second time among the row's own ones; order, NULLs and ties stay as they are."""
    df = spark.createDataFrame([("k", None, 1.0, "b", 1), ("k", "a", 2.0, "y", 2), ("k", "a", 2.0, "x", 3), ("k", "a", None, "a", 0), ("j", None, None, None, 4)],
                               "k string, s string, v double, t string, n int")
    top = top1(df, ["k"], [("s", "asc", "last"), ("v", "asc", "last")])
    assert {r.k: tuple(r)[1:] for r in top.collect()} == {"k": ("a", 2.0, "x", 3), "j": (None, None, None, 4)}
    assert top.columns == df.columns and "_row.s" not in top._jdf.queryExecution().analyzed().toString()
    assert [tuple(r) for r in top1(df.select("k", "s"), ["k"], [("s", "asc", "last")]).orderBy("k").collect()] == [("j", None), ("k", "a")]


def test_point_in_time_latest_overlapping_and_orphan(spark):
    ev = spark.createDataFrame([("e1", "p", D(1997, 6, 1)), ("e2", "p", D(2005, 1, 1)), ("e3", "q", D(1997, 1, 1))],
                               "eid string, pid string, d date")
    per = spark.createDataFrame([("p", D(1995, 1, 1), D(1997, 12, 31), 1), ("p", D(1997, 1, 1), D(1998, 12, 31), 2),
                                 ("p", D(1999, 1, 1), D(1996, 12, 31), 3),   # inverted: never valid
                                 ("q", None, D(1999, 12, 31), 1)],            # no start: never valid
                                "pid string, f date, t date, v int")
    out = point_in_time_join(ev, per, "pid", ev.d, "f", "t", [("f", "desc", "first"), ("v", "desc", "first")])
    got = {r.eid: r.pit_v for r in out.collect()}
    assert got == {"e1": 2, "e2": None, "e3": None}


def test_sequence_number_equals_row_number_with_copies_and_a_hot_key(spark):
    import random

    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from clinlake.operators.ranking import sequence_number

    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        p = "hot" if i % 3 == 0 else f"p{rnd.randrange(40)}"
        y = rnd.choice([None, 1995, 1996, 1997, 1998])
        rows.append((p, y, rnd.choice(["a", "b", None]), rnd.randrange(3)))
    rows += [("hot", 1996, "a", 1)] * 700 + [("cold", None, None, 0)] * 5
    rows += [(None, 1995, "a", 1)] * 3 + [(None, None, None, 0), (None, 1994, "b", 2)]   # NULL partition key
    df = spark.createDataFrame(rows, "p string, y int, s string, n int")
    order = ["y", "s", "n"]
    want = df.withColumn("v", F.row_number().over(
        Window.partitionBy("p").orderBy(*[F.col(c).asc_nulls_last() for c in order])))
    for chunk in (1 << 16, 100, 1):   # whatever the size of the pieces
        got = sequence_number(df, ["p"], order, "v", chunk=chunk)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_join_period_of_year_equals_the_ranged_join(spark):
    """For whole-year periods both point-in-time joins agree, on events with distinct ids."""
    import random

    from clinlake.operators.point_in_time import join_period_of_year

    r = random.Random(2)
    ev = spark.createDataFrame([(f"e{i}", r.choice(["a", "b", "hot", None]),
                                 None if i % 50 == 0 else dt.date(r.randrange(1994, 2003), r.randrange(1, 13), 5)) for i in range(400)],
                               "eid string, pid string, d date")
    per = []
    for i in range(60):
        start = r.randrange(1993, 2002)
        per.append((r.choice(["a", "b", "hot"]), dt.date(start, 1, 1), dt.date(start + r.randrange(3), 12, 31), i))
    per = spark.createDataFrame(per, "pid string, f date, t date, v int")
    latest = [("f", "desc", "first"), ("v", "desc", "first")]
    want = point_in_time_join(ev, per, "pid", ev.d, "f", "t", latest)
    got = join_period_of_year(ev, per, "pid", ev.d, "f", "t", latest)
    assert sorted((x.eid, x.pit_v) for x in got.collect()) == sorted((x.eid, x.pit_v) for x in want.collect())


def test_point_in_time_on_arbitrary_dates_equals_brute_force(spark):
    """Ranges of any days and lengths, copies, inverted and open ones, repeated events, and a patient with most of them."""
    import random

    r = random.Random(11)
    day = lambda: D(1995, 1, 1) + dt.timedelta(days=r.randrange(1500))
    events = [(f"e{i}", "hot" if i % 3 else r.choice(["a", "b", None]), None if i % 41 == 0 else day()) for i in range(500)]
    events += [("e1", "hot", events[1][2])] * 3
    periods = []
    for i in range(120):
        start = day()
        periods.append(("hot" if i % 2 else r.choice(["a", "b", "c", None]), start, start + dt.timedelta(days=r.choice([-5, 0, 1, 30, 400, 900])), i % 7))
    periods += [periods[3]] * 4 + [("hot", None, D(1996, 1, 1), 1), ("hot", D(1996, 1, 1), None, 1), ("a", D(1995, 12, 31), D(1996, 1, 1), 9)]

    def winner(key, at):
        valid = [p for p in periods if key is not None and at is not None and p[0] == key and None not in p[1:3] and p[1] <= at <= p[2]]
        return max(valid, key=lambda p: (p[1], p[3], p[2]))[1:] if valid else (None, None, None)

    ev = spark.createDataFrame(events, "eid string, pid string, d date")
    per = spark.createDataFrame(periods, "pid string, f date, t date, v int")
    got = point_in_time_join(ev, per, "pid", ev.d, "f", "t", [("f", "desc", "first"), ("v", "desc", "first"), ("t", "desc", "first")])
    assert sorted(((x.eid, x.pid, x.d), (x.pit_f, x.pit_t, x.pit_v)) for x in got.collect() if x.pid) == sorted(
        (e, winner(*e[1:])) for e in events if e[1])
    assert got.count() == len(events)


def test_overlap_count_equals_the_pairs(spark):
    import random

    from clinlake.operators.overlaps import overlap_count

    r = random.Random(5)
    rows = []
    for k in ["hot", "a", "b", "c", None]:
        own = []
        for _ in range(150 if k == "hot" else r.randrange(12)):
            start = None if r.random() < 0.05 else D(1990, 1, 1) + dt.timedelta(days=r.randrange(2000))
            own.append((start, None if r.random() < 0.1 else (start or D(1992, 1, 1)) + dt.timedelta(days=r.randrange(-100, 700))))
        own += own[:3]
        own.sort(key=lambda x: (x[0] is None, x[0] or D(1, 1, 1)))
        rows += [(k, a, b, i + 1) for i, (a, b) in enumerate(own)]
    df = spark.createDataFrame(rows, "k string, a date, b date, i int")
    want = sum(x[0] == y[0] and x[3] < y[3] and x[2] is not None and y[1] is not None and x[2] >= y[1] for x in rows for y in rows)
    assert overlap_count(df, "k", "a", "b", "i").collect()[0].pairs == want > 100
    assert overlap_count(df.limit(0), "k", "a", "b", "i").collect()[0].pairs == 0


def test_ledger_counts_every_domain_in_one_shuffle(spark):
    import collections
    import random

    from clinlake.operators.ledger import Entry, domain_totals, key_ledger

    r = random.Random(1)
    parents = [(r.choice(["x", "y", "z", None, "hot"]),) for _ in range(30)]
    children = [("hot" if i % 3 else r.choice(["x", "q", "w", None]), r.randrange(4)) for i in range(400)]
    p = spark.createDataFrame(parents, "k string")
    c = spark.createDataFrame(children, "k string, n int")
    ledger = key_ledger([(p, [Entry(0, 0, "k")]), (c, [Entry(0, 1, "k"), Entry(1, 0, "CASE WHEN n > 1 THEN n END"),
                                                              Entry(2, 0, "CASE WHEN n = 9 THEN '' END")])])
    plan = ledger._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    got = {x.domain: x for x in domain_totals(ledger).collect()}
    held = collections.Counter(x[0] for x in parents if x[0])
    asked = collections.Counter(x[0] for x in children if x[0])
    assert got[0].repeated[0] == sum(n > 1 for n in held.values()) and got[0].repeated[1] == sum(n > 1 for n in asked.values())
    assert got[0].orphans[1] == sum(n for k, n in asked.items() if k not in held) and got[0].rows[1] == sum(asked.values())
    assert got[1]["keys"] == 2 and got[1].rows[0] == sum(n > 1 for _, n in children) and 2 not in got
