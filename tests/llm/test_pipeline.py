"""The pipeline on the smallest tables, stage by stage against brute force."""
import re

import pytest

import corpus_pipeline as C
from test_decontamination import brute as leaks
from test_private_data import base

SF = "/root/testdata/sf0.001"


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Input and output rows of every stage, each written and read again."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {}
    for name, stage in C.STAGES:
        result = stage(spark, docs, SF)
        if name != C.STAGES[-1][0]:
            assert result.schema.simpleString() == docs.schema.simpleString()
        result.write.parquet(f"{folder}/{name}")
        result = spark.read.parquet(f"{folder}/{name}")
        out[name] = ({r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in result.collect()})
        docs = result
    return out


def test_quality_keeps_good_and_drops_bad(spark, steps):
    before, after = steps["quality"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good, bad = [i for i in labels if labels[i] == 1], [i for i in labels if labels[i] == 0]
    assert sum(i in after for i in good) >= 0.97 * len(good) and sum(i in after for i in bad) <= 0.1 * len(bad)
    assert all(before[i] == r for i, r in after.items())


def test_near_duplicates_keep_the_first_of_each_group(steps):
    before, after = steps["near_duplicates"]
    sets = {i: shingles(r.text) for i, r in before.items()}
    group = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i in sets:
            for j in sets:
                both = len(sets[i] & sets[j])
                if i < j and both and 5 * both >= 4 * len(sets[i] | sets[j]) and group[i] != group[j]:
                    group[i] = group[j] = min(group[i], group[j])
                    changed = True
    assert set(after) == {i for i in group if group[i] == i}


def test_decontamination_drops_leaks_only(spark, steps):
    before, after = steps["decontamination"]
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {x[0] for x in leaks([(i, r.text) for i, r in before.items()], bench) if x[-1]}
    assert set(after) == set(before) - bad


def test_private_data_is_masked(steps):
    before, after = steps["private_data"]
    assert set(after) == set(before)
    touched = 0
    for i, r in after.items():
        assert not base(r.text) and r.n_chars == len(r.text or "")
        if base(before[i].text):
            touched += 1
        elif "[CONTEXT]" not in (r.text or ""):
            assert r.text == before[i].text
    assert touched


def test_last_stage_round_trips(spark, steps):
    before, after = steps["sentencepiece"]
    assert set(after) == set(before)
    assert all(r.text == (before[i].text or "") and r.n_ids == len(r.ids) for i, r in after.items())
    got = C.run(spark, SF)
    assert {r.doc_id: tuple(r) for r in got.collect()} == {i: tuple(r) for i, r in after.items()}


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in C.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.collect() == []


CLASHES = ["_text", "_gone", "_bad", "_more", "_doc", "_hash", "_row", "keep", "cluster", "id", "component_id"]


def odd_documents(spark):
    """Documents without an id, with repeated ids, and with columns that operators might use."""
    long = " ".join(f"word{i}" for i in range(60))
    rows = [(1, long), (1, long), (None, long + " tail"), (2, "mail me: someone@mail.com please"), (None, "mail me: other@mail.com please"),
            (3, None), (None, None), (4, ""), (5, "other text of five words here"), (None, "other text of five words here")]
    names = ", ".join(f"{c} string" for c in CLASHES)
    return spark.createDataFrame([(*x, *[f"{c}{i}" for c in CLASHES]) for i, x in enumerate(rows)], f"doc_id long, text string, {names}").repartition(3)


def test_stages_keep_odd_rows_and_other_columns(spark):
    from clinlake.llm import decontamination, near_duplicates, private_data, quality

    docs = odd_documents(spark)
    rows = sorted(map(repr, docs.collect()))
    bench = spark.createDataFrame([("b1", "mail me other mail com please")], "item_id string, text string")

    firsts = near_duplicates.first_copies(docs, threshold=0.8)
    assert firsts.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in firsts.collect()]
    assert sorted(map(repr, firsts.collect())) == sorted(x for x in rows if x in set(map(repr, firsts.collect())))
    assert sum(t is not None and t.startswith("word0") for _, t in kept) == 1 and (5, "other text of five words here") in kept
    assert (None, "other text of five words here") not in kept and len(kept) == 10 - 2 - 1

    clean = decontamination.clean(docs, bench).collect()
    assert sorted(map(repr, clean)) == [x for x in rows if "other@mail" not in x]

    masked = private_data.redact(docs)
    assert masked.columns == docs.columns
    by_key = {r._gone: r for r in docs.collect()}
    for r in masked.collect():
        assert all(r[c] == by_key[r._gone][c] for c in CLASHES) and r.doc_id == by_key[r._gone].doc_id and "@" not in (r.text or "")

    labels = spark.createDataFrame([(1, 1), (2, 0), (5, 1)], "doc_id long, quality int")
    model = quality.fit(quality.training_rows(docs, labels))
    good = quality.good_documents(docs, model, threshold=0.0)
    assert sorted(map(repr, good.collect())) == rows


def test_last_stage_encodes_rows_without_an_id(spark):
    docs = odd_documents(spark).select("doc_id", "text")
    got = C.sentencepiece_stage(spark, docs, SF).collect()
    assert sorted((repr(r.doc_id), r.text) for r in got) == sorted((repr(r.doc_id), r.text or "") for r in docs.collect())
