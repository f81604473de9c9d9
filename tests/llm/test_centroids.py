"""Centroid clustering against a plain loop over Python integers and against SQL."""
import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest

from clinlake.llm import centroids as C
from clinlake.llm import sql
from oracle import duck, rows


def plain(data, k=40, rounds=5, dim=64):
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in data
            if i is not None and v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    cents = [v for _, v in sorted(kept, key=lambda r: (hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))[:k]]

    def assigned():
        d = [[sum((a - b) ** 2 for a, b in zip(v, c)) for c in cents] for _, v in kept]
        return [(min(range(len(x)), key=lambda j: (x[j], j)), min(x)) for x in d]

    for _ in range(rounds):
        best = assigned() if kept else []
        for c in range(len(cents)):
            own = [v for (_, v), (b, _) in zip(kept, best) if b == c]
            if own:
                cents[c] = [sum(col) // len(own) for col in zip(*own)]
    best = assigned() if kept else []
    total = sum(d for _, d in best)
    return sorted((i, b, d, sum(e for a, e in best if a == b), total, hashlib.sha256(",".join(map(str, cents[b])).encode()).hexdigest())
                  for (i, _), (b, d) in zip(kept, best))


def vectors(seed, n=300, dim=64):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dim)) * rng.uniform(0.05, 2, (n, 1))
    v[n // 2:] = v[0] + rng.normal(size=(n - n // 2, dim)) * 0.01  # half in one place
    v[10:20] = v[1]
    v[30] = 500000.0 * np.where(np.arange(dim) % 2, 1, -1)
    data = [(i, [float(np.float32(x)) for x in r]) for i, r in enumerate(v)]
    data += [(7, data[7][1]), (7, data[8][1]), (5000, None), (5001, []), (5002, [1.0] * (dim - 1)), (5003, [1.0] * (dim + 1)),
             (5004, [None] + [1.0] * (dim - 1)), (5005, [math.nan] * dim), (5006, [math.inf] + [0.0] * (dim - 1)), (None, [0.0] * dim), (-3, [0.0] * dim)]
    return data


def frame(spark, data):
    return spark.createDataFrame([(*x, 9, 0.5) for x in data], "vec_id long, embedding array<float>, cluster int, distance double").repartition(4)


@pytest.mark.parametrize("n,k", [(300, 40), (25, 40), (60, 3)])
def test_equals_a_plain_loop(spark, n, k):
    data = vectors(n, n=max(n, 31))[:n] if n < 31 else vectors(n, n=n)
    got = sorted(map(tuple, C.cluster(frame(spark, data), k=k).collect()))
    assert got == plain(data, k=k)


def test_equals_sql(spark):
    data = vectors(5, n=150)
    t = pa.table({"vec_id": pa.array([x[0] for x in data], pa.int64()), "embedding": pa.array([x[1] for x in data], pa.list_(pa.float32()))})
    assert rows(C.cluster(frame(spark, data))) == duck(sql.OP13, embeddings=t)


def test_extreme_components_and_empty(spark):
    data = vectors(1, n=40) + [(9001, [1e308] * 64), (9002, [-1e6] * 64)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, C.cluster(df, k=5).collect()))
    assert got == plain([x for x in data if x[0] not in (9001, 9002)], k=5)
    assert C.cluster(df.limit(0)).collect() == []
    assert C.cluster(df.filter("vec_id > 9000")).collect() == []


def test_tables_equal_differences():
    rng = np.random.default_rng(0)
    for spread in (3, 500, 1 << 26):
        v, c = rng.integers(-spread, spread, (200, 8)).astype(np.int32), rng.integers(-spread, spread, (6, 8))
        d = ((v[:, None, :].astype(np.int64) - c[None]) ** 2).sum(axis=2)
        best, dist = C.nearest(v, c)
        assert (best == d.argmin(axis=1)).all() and (dist == d.min(axis=1)).all()
