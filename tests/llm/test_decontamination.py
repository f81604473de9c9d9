"""Winnowing against a brute-force search of every window."""
import hashlib
import random
import re

from clinlake.llm import decontamination as D


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, bench):
    out = []
    windows = []
    for item, text in bench:
        w = words(text)
        if item is not None and w:
            n = min(10, len(w))
            windows += [(item, tuple(w[i:i + n])) for i in range(len(w) - n + 1)]
    for doc, text in docs:
        w = words(text)
        hit, items = set(), set()
        for item, x in windows:
            for s in range(len(w) - len(x) + 1):
                if tuple(w[s:s + len(x)]) == x:
                    hit |= set(range(s, s + len(x)))
                    items.add(str(item))
        names = ",".join(sorted(items))
        out.append((doc, len(w), len(hit), len(items), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out)


def fixture():
    r = random.Random(3)
    vocab = ["alpha", "Beta", "g", "délta", "e9", "ζ", "eta"]
    long = " ".join(r.choice(vocab) for _ in range(60))
    bench = [(i, " ".join(r.choice(vocab) for _ in range(n))) for i, n in enumerate([25, 12, 10, 9, 4, 40])]
    bench += [(20, None), (21, " .. "), (22, bench[0][1]), (None, "alpha Beta"), (23, bench[0][1])]
    docs = []
    for i in range(40):
        text = " ".join(r.choice(vocab) for _ in range(r.randint(0, 120)))
        if i % 3 == 0:
            item = r.choice(bench[:6])[1].split()
            a = r.randint(0, len(item))
            text += "; " + "-".join(item[a:a + r.randint(8, 14)]).upper() + " " + text[:30]
        docs.append((i, text))
    docs += [(100, None), (101, ""), (102, bench[0][1]), (102, bench[0][1]), (103, long * 30)]
    return docs, bench


def frames(spark, docs, bench):
    d = spark.createDataFrame([(*x, "extra", 1) for x in docs], "doc_id long, text string, items string, n_words int")
    return d, spark.createDataFrame(bench, "item_id long, text string")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_digest_equals_brute_force(spark):
    docs, bench = fixture()
    d, b = frames(spark, docs, bench)
    assert rows(D.digest(D.contamination(d, b))) == brute(docs, bench)


def test_blocks_give_the_same_result(spark):
    docs, bench = fixture()
    d, b = frames(spark, docs, bench)
    assert rows(D.digest(D.contamination(d, b, block_windows=40))) == brute(docs, bench)


def test_empty_tables_and_missing_ids(spark):
    docs, bench = fixture()
    d, b = frames(spark, docs[:3] + [(None, "alpha")], bench)
    assert rows(D.digest(D.contamination(d, b.limit(0)))) == brute(docs[:3], [])
    assert rows(D.digest(D.contamination(d.limit(0), b))) == []


def test_clean_keeps_columns_and_clean_rows(spark):
    docs, bench = fixture()
    d, b = frames(spark, docs, bench)
    bad = {x[0] for x in brute(docs, bench) if x[-1]}
    kept = D.clean(d, b)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in docs if i not in bad)
