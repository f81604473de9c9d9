"""Near duplicates against SQL over all pairs, with small buckets and clusters, and the bounds."""
import random
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from clinlake.llm import near_duplicates as N
from clinlake.llm import sql
from clinlake.llm.components import components
from oracle import duck, rows


def corpus(seed):
    r = random.Random(seed)
    word = lambda: f"W{r.randrange(3000)}"
    texts = []
    for size in (12, 40, 200):
        for _ in range(4):
            base = [word() for _ in range(size)]
            for _ in range(14):  # similarities on both sides of the threshold
                copy = list(base)
                for _ in range(r.randrange(1 + size // 25 + 1)):
                    copy[r.randrange(size)] = word()
                texts.append(" ".join(copy[:len(copy) - r.choice([0, 0, 1])]))
    hub = [word() for _ in range(120)]
    for _ in range(60):  # one large group of near copies
        copy = list(hub)
        for _ in range(r.randrange(4)):
            copy[r.randrange(120)] = word()
        texts.append(" ".join(copy))
    texts += [" ".join(hub).lower()] * 4 + [None, "", "  ", "a", "A", "a b c d", "A\nb\tC d", "a b c d e", "é ê", "É ê"]
    r.shuffle(texts)
    return list(enumerate(texts))


def frame(spark, docs):
    return spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, id string, n int").repartition(5)


@pytest.mark.parametrize("settings", [{}, {"bucket": 4, "cluster": 8}, {"bucket": 3, "cluster_shingles": 300}])
def test_equals_sql(spark, settings):
    docs = corpus(len(settings))
    documents = pa.table({"doc_id": [d[0] for d in docs], "text": pa.array([d[1] for d in docs], pa.string())})
    got = N.near_duplicates(frame(spark, docs), threshold=0.85, **settings)
    assert rows(got) == duck(sql.OP7, documents=documents)


def test_first_copies_and_other_thresholds(spark):
    docs = corpus(9)
    got = N.first_copies(frame(spark, docs), threshold=0.8)
    documents = pa.table({"doc_id": [d[0] for d in docs], "text": pa.array([d[1] for d in docs], pa.string())})
    want = duck(f"SELECT doc_id FROM ({sql.OP7.replace('85 *', '80 *')}) WHERE kept", documents=documents)
    assert got.columns == ["doc_id", "text", "id", "n"]
    assert sorted(r.doc_id for r in got.collect()) == sorted(r[0] for r in want)


def test_repeated_missing_and_empty(spark):
    df = spark.createDataFrame([(5, "a b c d e f"), (5, "a b c d e f"), (3, "A B C D E F"), (None, "a b c d e f"), (9, None)],
                               "doc_id long, text string")
    assert rows(N.near_duplicates(df)) == sorted([(3, 3, True, 2), (3, 5, False, 2), (3, 5, False, 2), (9, 9, True, 0)], key=repr)
    assert N.near_duplicates(df.limit(0)).collect() == []


def test_xor_bound_holds():
    """Links of sampled sets at the threshold stay within the bound; far pairs mostly do not."""
    plan = N.Plan.of(Fraction(17, 20), 5, 1e-8)
    rng = np.random.default_rng(4)
    k = plan.bands * N.ROWS
    ones = []
    for differing in rng.binomial(k, 0.15, 4000):
        ones.append(int((np.bincount(rng.integers(0, N.BITS, 2 * differing), minlength=N.BITS) & 1).sum()))
    assert max(ones) <= plan.most < 110
    far = [int((np.bincount(rng.integers(0, N.BITS, 2 * d), minlength=N.BITS) & 1).sum()) for d in rng.binomial(k, 0.7, 500)]
    assert np.mean(np.array(far) > plan.most) > 0.9


def test_components_of_random_graphs(spark):
    r = random.Random(8)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1100)] + [
        (2000, i) for i in range(2001, 2200)] + [(7, 7)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
