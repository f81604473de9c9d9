"""Substring dedup against SQL over all windows, and against a plain loop for other settings."""
import random

import pyarrow as pa
import pytest

from clinlake.llm import sql
from clinlake.llm import substrings as S
from oracle import duck, rows


def corpus(seed, n=120):
    r = random.Random(seed)
    vocab = ["a", "B", "éa", "d.", "e", "\u00a0x", "g", "h"] if seed % 2 else [f"w{i}" for i in range(400)]
    line = " ".join(r.choice(vocab) for _ in range(18))
    passages = [" ".join(r.choice(vocab) for _ in range(r.randint(15, 90))) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(r.randint(0, 4)):
            kind = r.random()
            parts.append(line if kind < .2 else r.choice(passages) if kind < .5
                         else " ".join(r.choice(vocab) for _ in range(r.randint(0, 60))))
        texts.append(r.choice(["\n", " ", "\t \r\n"]).join(parts))
    base = " ".join(r.choice(vocab) for _ in range(300)).split()
    for _ in range(30):  # near copies
        copy = list(base)
        copy[r.randrange(300)] = "edit" + str(r.randrange(9))
        texts.append(" ".join(copy))
    texts += [base and " ".join(base)] * 5 + [None, "", " \n ", "one", " ".join(["same"] * 100), " ".join(["same"] * 100)]
    return list(enumerate(texts))


def frame(spark, docs):
    r = random.Random(1)
    return spark.createDataFrame(r.sample([(*d, 0, "x") for d in docs], len(docs)), "doc_id long, text string, low int, ranges string").repartition(7)


@pytest.mark.parametrize("seed", [0, 1])
@pytest.mark.parametrize("piece,spread", [(4 << 20, 16), (3000, 16), (3000, 1)])
def test_equals_sql(spark, monkeypatch, seed, piece, spread):
    docs = corpus(seed)
    monkeypatch.setattr(S, "PIECE", piece)
    got = S.remove_repeats(S.whole_documents(frame(spark, docs)), spread=spread, texts=False).withColumnRenamed("kept", "kept_sha256")
    documents = pa.table({"doc_id": [d[0] for d in docs], "text": pa.array([d[1] for d in docs], pa.string())})
    assert rows(got) == duck(sql.OP1, documents=documents)


def test_texts_and_other_windows(spark):
    docs = corpus(1, 40)
    got = {r.doc_id: r for r in S.remove_repeats(S.whole_documents(frame(spark, docs)), window=7, k=3).collect()}
    seen = set()
    for i, t in docs:
        w = (t or "").replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        w = [x for x in w if x]
        gone = set()
        for s in range(len(w) - 6):
            key = tuple(w[s:s + 7])
            if key in seen:
                gone |= set(range(s, s + 7))
            seen.add(key)
        assert got[i].n_words == len(w) and got[i].n_removed == len(gone)
        assert got[i].kept == " ".join(x for j, x in enumerate(w) if j not in gone)


def test_repeated_and_missing_ids(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(1, text), (1, text), (2, "b " + text), (2, "a"), (None, text), (3, None)], "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in S.remove_repeats(S.whole_documents(df)).collect()}
    assert got == {1: (40, 0, text), 2: (42, 40, "a b"), 3: (0, 0, "")}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.remove_repeats(S.whole_documents(df)).collect() == []
