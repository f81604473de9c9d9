"""Exact top-k against SQL over all pairs."""
import math

import numpy as np
import pyarrow as pa
import pytest

from clinlake.llm import sql
from clinlake.llm import topk as T
from oracle import duck, rows


def vectors(seed, n=700, dim=16):
    rng = np.random.default_rng(seed)
    v = (rng.normal(size=(n, dim)) * rng.uniform(0.2, 2, (n, 1))).astype(np.float32)
    v[n // 2:n // 2 + 60] = v[0]  # ties
    v[5] = 0
    rows_ = [(i, x.tolist()) for i, x in enumerate(v)]
    rows_ += [(1000, None), (1050, [1.0, None, *[0.0] * (dim - 2)]), (1100, [math.nan] * dim), (1150, [math.inf] * dim), (None, [1.0] * dim)]
    return rows_


def tables(spark, data):
    df = spark.createDataFrame([(*x, 1) for x in data], "vec_id long, embedding array<float>, score int").repartition(5)
    return df, pa.table({"vec_id": pa.array([x[0] for x in data], pa.int64()), "embedding": pa.array([x[1] for x in data], pa.list_(pa.float32()))})


@pytest.mark.parametrize("settings", [{}, {"block_rows": 50}, {"batch_bytes": 512}])
def test_equals_sql(spark, settings):
    df, t = tables(spark, vectors(len(settings)))
    got = T.top_k(df.filter("vec_id % 50 = 0"), df, **settings)
    assert rows(got) == duck(sql.OP9, embeddings=t)


def test_few_rows_and_empty(spark):
    df, t = tables(spark, vectors(3)[:3])
    assert rows(T.top_k(df.filter("vec_id % 50 = 0"), df)) == duck(sql.OP9, embeddings=t)
    assert T.top_k(df.limit(0), df).collect() == [] and T.top_k(df, df.limit(0)).collect() == []


def test_large_components_and_lengths(spark):
    big = 3.0e18
    df = spark.createDataFrame([(0, [big, 1.0]), (1, [big, 1.0]), (2, [-big]), (3, []), (50, [0.5])], "vec_id long, embedding array<double>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in T.top_k(df.filter("vec_id % 50 = 0"), df).collect()}
    assert got[0, 1] == (1, (1 << 63) - 1) and got[0, 4] == (2, -(1 << 63))
    assert got[50, 3] == (3, 0)


def test_stops_only_on_proof():
    """Rows left by the bounds hold the best k, and usually are few."""
    rng = np.random.default_rng(6)
    rows_ = np.floor(256 * rng.normal(size=(4000, 16)) * rng.exponential(1, (4000, 1)))
    block = T.Block(np.arange(4000), rows_)
    left = []
    for i in range(20):
        q = rows_[i]
        found = set(block.candidates(q, i, 5, -np.inf).tolist())
        best = [j for j in np.argsort(-(rows_ @ q), kind="stable") if j != i][:5]
        assert set(best) <= found
        left.append(len(found))
    assert np.mean(left) < 400


def test_components_that_overflow(spark):
    rows_ = [(i, [1e308 * (1 if i % 3 else -1), 1.0]) for i in range(0, 200, 10)] + [(i, [0.5, 0.25]) for i in range(1, 9)]
    df = spark.createDataFrame(rows_, "vec_id long, embedding array<double>")
    got = T.top_k(df.filter("vec_id % 50 = 0"), df).collect()
    assert len(got) == 20 and max(r.score for r in got) == (1 << 63) - 1


def test_rows_are_held_against_a_known_score(monkeypatch):
    """With a known score one accumulation per block and query is enough, and no row that reaches it is lost."""
    rng = np.random.default_rng(8)
    rows_ = np.floor(256 * rng.normal(size=(3000, 16)))
    block, calls, count = T.Block(np.arange(3000), rows_), [], np.bincount
    queries = rows_[:30]
    known = block.known_scores(queries, np.arange(30), 5)
    monkeypatch.setattr(np, "bincount", lambda *a, **b: calls.append(1) or count(*a, **b))
    for i in range(30):
        scores = np.where(np.arange(3000) == i, -np.inf, rows_ @ queries[i])
        assert known[i] == np.sort(scores[:512])[-5]
        found = set(block.candidates(queries[i], i, 5, known[i]).tolist())
        assert set(np.argsort(-scores, kind="stable")[:5].tolist()) <= found
    assert len(calls) == 30


def test_no_score_is_known_of_few_or_huge_rows():
    ids = np.arange(5)
    assert T.Block(ids, np.ones((5, 2))).known_scores(np.ones((1, 2)), ids[:1], 5).tolist() == [-np.inf]
    assert T.Block(np.arange(9), np.full((9, 2), 1e100)).known_scores(np.ones((1, 2)), ids[:1], 5).tolist() == [-np.inf]
