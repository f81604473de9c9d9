"""Quality classifier: held-out accuracy, calibration and corner cases."""
import zlib

import numpy as np
import pyarrow as pa
import pytest

from clinlake.llm import quality as Q
from clinlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    got = QUERIES["op10_quality"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = got.join(labels, "doc_id").filter("held_out").select("score", "predicted", "quality").collect()
    assert len(rows) > 500
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.98
    clean = [r for r in rows if r.quality == 1]
    assert np.mean([r.predicted for r in clean]) > 0.99
    all_ = got.collect()
    assert len({r.doc_id for r in all_}) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in all_)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in all_)


def test_isotonic_equals_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(30):
        total = rng.integers(0, 6, 20).astype(float)
        good = np.floor(total * rng.random(20))
        got = Q.isotonic(good, total)
        assert np.all(np.diff(got) >= 0) and got.min() >= 0 and got.max() <= 1
        # max-min formula of the isotonic fit, on bins with rows
        own = np.flatnonzero(total)
        fit = [max(min(good[a:b + 1].sum() / total[a:b + 1].sum() for b in own if b >= i) for a in own if a <= i) for i in own]
        order = np.argsort(fit, kind="stable")
        assert np.all(np.diff(got[own][order]) >= -1e-12)


def test_kernel_is_approximated():
    rng = np.random.default_rng(0)
    k, width = len(Q.FEATURES), 6.0
    m = Q.Model(np.zeros(k), np.ones(k), rng.normal(size=(k, 20_000)) / width, rng.uniform(0, 2 * np.pi, 20_000),
                np.zeros(20_001), 0.0, 1.0, np.zeros(4))
    x = rng.normal(size=(6, k))
    z = m.features(x)[:, 1:]
    want = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * width ** 2))
    assert np.abs(z @ z.T - want).max() < 0.05


def test_statistics_of_odd_texts():
    x = Q.statistics(pa.array([None, "", " ", "\n\n", "a", "é" * 300_000, "x " * 5, "A!! B!!"], pa.string()))
    assert x.shape == (8, len(Q.FEATURES)) and np.isfinite(x).all()
    assert not x[0].any() and not x[1].any()


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(None, 1), (1, None), (9, 0)]])
def test_few_or_no_labels(spark, labels):
    docs = spark.createDataFrame([(1, "a b", 2), (1, "a b", 2), (2, None, 2), (None, "c", 2)], "doc_id long, text string, score int")
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    rows = Q.scores(Q.feature_table(docs), Q.fit(Q.training_rows(docs, lab))).collect()
    assert sorted(r.doc_id for r in rows) == [1, 1, 2] and all(0 <= r.score <= 1 for r in rows)
    assert Q.good_documents(docs, Q.fit(Q.training_rows(docs, lab))).columns == docs.columns


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    lab = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert Q.scores(Q.feature_table(docs), Q.fit(Q.training_rows(docs, lab))).collect() == []


def test_fit_equals_a_dense_one(spark):
    """The summed normal equations and the bins give what one process computes on all rows at once."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(7)
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    features = Q.feature_table(docs)
    model = Q.fit(Q.labelled(features, labels), dim=32, ridge=1e-2, bins=64, seed=3)
    rows = Q.labelled(features, labels).collect()
    x, y = np.array([r.x for r in rows]), np.array([r.y for r in rows])

    rng = np.random.default_rng(3)
    weights, phase = rng.normal(size=(x.shape[1], 32)) / 6.0, rng.uniform(0, 2 * np.pi, 32)
    scale = x.std(axis=0)
    scale[scale < 1e-5] = 1.0
    z = np.cos(np.clip((x - x.mean(axis=0)) / scale, -4, 4) @ weights + phase) * np.sqrt(2 / 32)
    z = np.hstack([np.ones((len(x), 1)), z])
    # ridge as an augmented least-squares problem, without normal equations
    stacked = np.vstack([z, np.sqrt(1e-2 * len(x) / 32) * np.eye(33)])
    coef = np.linalg.lstsq(stacked, np.concatenate([y, np.zeros(33)]), rcond=None)[0]
    assert np.allclose(model.raw(x), z @ coef, atol=1e-6)
    at = np.clip(((z @ coef + 0.5) / 2 * 64).astype(int), 0, 63)
    calibrated = Q.isotonic(np.bincount(at, weights=y, minlength=64), np.bincount(at, minlength=64).astype(float))
    assert np.mean(np.isclose(model.score(x), calibrated[at], atol=1e-6)) > 0.99  # rows at the edge of a bin may change sides
    got = {r.doc_id: r.score for r in Q.scores(features, model).collect()}
    assert len(got) == docs.count()
