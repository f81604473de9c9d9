"""URL filter against SQL, and what the templates learn."""
import random

import pyarrow as pa

from clinlake.llm import sql
from clinlake.llm import url_filter as U
from oracle import duck, rows


def urls():
    r = random.Random(2)
    out = [None, "", "no scheme", "http://", "https://EXAMPLE.org", "http://example.org/es/1", "http://a.Example.ORG/es/x?q=/de/",
           "http://example.org/en/12#x", "http://example.org/en/2", "https://notexample.org/es/", "x://com/de/", "x://acom/de/",
           "http://a.com/fr/", "http://a.com/fr", "http://a.com?x=/fr/", "a://b://c.com/de/1", "http://h.net/" + "a/" * 40,
           "http://u@h.com:80/de/x", "http://é.org/ü/1", "http://a.com//de/", "http://h.net/a\nb/c"]
    for _ in range(900):
        host = r.choice(["shop.com", "x.shop.com", "news.net", "m.example.org", "w.org"])
        part = r.choice(["de", "fr", "en", "es"])
        out.append(f"https://{host}/{part}/{r.choice(['buy', 'view', r.randrange(900)])}/{r.randrange(10 ** 4)}{r.choice(['', '.html', '/'])}")
    return out


def test_equals_sql(spark):
    data = [(i % 910 if i else None, u) for i, u in enumerate(urls())]
    df = spark.createDataFrame([(*x, "h", 1) for x in data], "page_id long, url string, html string, n int").repartition(4)
    t = pa.table({"page_id": pa.array([x[0] for x in data], pa.int64()), "url": pa.array([x[1] for x in data], pa.string())})
    assert rows(U.verdicts(df)) == duck(sql.OP5, pages=t)


def test_templates_of_labelled_branches_are_rejected(spark):
    """Unlabelled pages of a branch follow its labelled ones; other branches are allowed."""
    rules = (("shop.net/offer/1", "block"), ("shop.net/help/1", "allow"))
    pages = [(i, f"http://shop.net/{b}/{10_000 + i if i % 2 else 90_000 + i}") for i, b in enumerate(["offer", "help", "other"] * 60)]
    df = spark.createDataFrame(pages, "page_id long, url string")
    for row in U.verdicts(df, rules).collect():
        if "/offer/" in row.path:
            assert row.verdict == "block" and row.template == "/offer/*"
        else:
            assert row.verdict == "allow"


def test_no_labels_and_empty(spark):
    df = spark.createDataFrame([(1, "http://a.net/x/1"), (1, "http://a.net/x/1"), (None, None)], "page_id long, url string")
    assert [r.verdict for r in U.verdicts(df).collect()] == ["allow"] * 3
    assert U.verdicts(df.limit(0)).collect() == []


def test_only_dataframe_functions(spark):
    df = spark.createDataFrame([(1, "http://a.net/x/1")], "page_id long, url string")
    plan = U.verdicts(df)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"))


def test_few_labels_do_not_reject_many_unlabelled_pages(spark):
    """4 pages under /de/ (blocked by rule) beside 100 under /en/ and /es/: only the 4 are blocked."""
    pages = [(i, f"http://one.com/de/{i}") for i in range(4)]
    pages += [(10 + i, f"http://one.com/{'en' if i % 2 else 'es'}/{i}") for i in range(100)]
    # half of another host's pages are labelled: the template is known well enough
    pages += [(200 + i, f"http://two.com/{'de' if i % 2 else 'en'}/{i}") for i in range(40)]
    df = spark.createDataFrame(pages, "page_id long, url string")
    got = {r.page_id: r.verdict for r in U.verdicts(df).collect()}
    assert all(got[i] == "block" for i in range(4)) and all(got[10 + i] == "allow" for i in range(100))
    assert all(got[200 + i] == "block" for i in range(40))
    t = pa.table({"page_id": pa.array([x[0] for x in pages], pa.int64()), "url": pa.array([x[1] for x in pages])})
    assert rows(U.verdicts(df)) == duck(sql.OP5, pages=t)


def test_nodes_of_deep_paths_are_told_apart(spark):
    """Paths that are alike for eight segments, and differ in shape after them, have nodes of their own."""
    paths = [f"/{'a/' * 8}{x}/p/{'b/' * 30}z" for x in ("x", "7", "y", "x-x")]
    df = spark.createDataFrame([("deep.net", p, 1, 0, 0) for p in paths], "host string, path string, n long, labelled long, blocked long")
    nodes = U.segments(df).filter("depth = 20").select("above").distinct().collect()
    assert len(nodes) == 3 and all(len(r.above) == 32 for r in nodes)
