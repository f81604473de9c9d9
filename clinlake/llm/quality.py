"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

1. A task computes document statistics (lengths, character classes, line and
   word repetition; see ``FEATURES``).  No id, language, source or label is an
   input of them.
2. The statistics are standardised by the labelled rows' moments and mapped to
   ``dim`` random Fourier features cos(W x + b), whose inner products
   approximate a Gaussian kernel of width ``width``.
3. Each partition sums its normal equations (Z'Z, Z'y); the sums of partitions
   are added by feature row, and the driver solves the dim x dim ridge system
   (its size does not depend on the data).
4. Raw scores of the labelled rows are counted in ``bins`` equal bins, and the
   pool-adjacent-violators method over the bins gives a monotone map to
   probabilities, smoothed by one half of a pseudo row per class.

Cases: null and empty texts have all-zero statistics and get a score like any
other; null labels and labels of unknown documents are ignored; a document
labelled several times counts with each label; rows without an id take no
part; without labels of both kinds every score is the share of good labels
(0.5 without any); an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.llm.common import WordArray, cut, documents, free_name, in_pieces, pieces, text_bytes

FEATURES = ("log_bytes", "log_words", "mean_word", "upper", "digit", "space", "newline", "punct", "symbol", "pipe",
            "bang", "non_ascii", "marked_words", "upper_words", "single_words", "long_words", "repeated_words",
            "top_word", "line_repeat", "log_line")


def _share(part: np.ndarray, whole: np.ndarray, damp: float = 0) -> np.ndarray:
    """part / whole; ``damp`` draws the shares of short texts to 0, where they say little."""
    return part / np.maximum(whole + damp, 1)


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of FEATURES for each text."""
    data, off = text_bytes(texts)
    n = len(off) - 1
    size = np.diff(off).astype(float)

    def count(mask: np.ndarray) -> np.ndarray:
        total = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=total[1:])
        return (total[off[1:]] - total[off[:-1]]).astype(float)

    def among(chars: str) -> np.ndarray:
        table = np.zeros(256, bool)
        table[[ord(c) for c in chars]] = True
        return table[data]

    upper = count((data >= 65) & (data <= 90))
    newline = count(data == 10)
    w = WordArray(texts)
    words = w.counts().astype(float)
    length = pc.binary_length(w.vocab).to_numpy(zero_copy_only=False) if len(w.vocab) else np.zeros(0, int)
    joined, starts = text_bytes(w.vocab)
    first_of = joined[starts[:-1]] if len(w.vocab) else np.zeros(0, np.uint8)
    last_of = joined[starts[1:] - 1] if len(w.vocab) else np.zeros(0, np.uint8)
    letters = (joined >= 97) & (joined <= 122)
    lower = np.add.reduceat(letters, starts[:-1]) if len(w.vocab) else np.zeros(0, int)

    def word_share(of_vocab: np.ndarray) -> np.ndarray:
        mask = of_vocab[w.codes] if w.n else np.zeros(0, bool)
        total = np.zeros(w.n + 1, np.int64)
        np.cumsum(mask, out=total[1:])
        return _share((total[w.off[1:]] - total[w.off[:-1]]).astype(float), words, 8)

    marks = np.zeros(256, bool)
    marks[[ord(c) for c in "#$%&*!|~^<>{}[]\\_=@"]] = True
    distinct, top = np.zeros(n), np.zeros(n)
    if w.n:
        keys, times = np.unique(w.doc_of() * np.int64(len(w.vocab)) + w.codes, return_counts=True)
        owner = keys // len(w.vocab)
        distinct = np.bincount(owner, minlength=n).astype(float)
        np.maximum.at(top, owner, times)
    lines = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    flat, line_off = lines.flatten(), lines.offsets.to_numpy().astype(np.int64)
    line_off = line_off - line_off[0]
    code = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    line_doc = np.repeat(np.arange(n), np.diff(line_off))
    kinds = np.bincount(np.unique(line_doc * (len(code) + 1) + code) // (len(code) + 1), minlength=n).astype(float)
    n_lines = np.diff(line_off).astype(float)
    def of_bytes(chars) -> np.ndarray:
        return _share(count(chars), size, 64)

    cols = [np.log1p(size), np.log1p(words), _share(size, words), _share(upper, size, 64),
            of_bytes((data >= 48) & (data <= 57)), of_bytes(data == 32), _share(newline, size, 64),
            of_bytes(among(".,;:?'\"()-")), of_bytes(among("#$%&*@~^<>{}[]\\_=+")), of_bytes(data == 124),
            of_bytes(data == 33), of_bytes(data >= 128), word_share(marks[last_of] | marks[first_of]),
            word_share((first_of >= 65) & (first_of <= 90) & (lower == 0)), word_share(length == 1),
            word_share(length > 16), _share(words - distinct, words, 8), _share(np.maximum(top - 1, 0), words, 8),
            _share(n_lines - kinds, n_lines, 2), np.log1p(_share(size, n_lines))]
    out = np.stack(cols, axis=1)
    out[size == 0] = 0
    return out


@dataclass
class Model:
    """A fitted classifier: small arrays that travel with the scoring tasks."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of the random features: FEATURES x dim
    phase: np.ndarray
    coef: np.ndarray
    low: float
    high: float
    calibrated: np.ndarray  # probability of each bin

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -4, 4)  # beyond, a text is as odd as it gets
        r = np.cos(z @ self.weights + self.phase) * np.sqrt(2 / len(self.phase))
        return np.concatenate([np.ones((len(x), 1)), r], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.coef

    def bin(self, raw: np.ndarray) -> np.ndarray:
        n = len(self.calibrated)
        return np.clip(((raw - self.low) / (self.high - self.low) * n).astype(int), 0, n - 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.calibrated[self.bin(self.raw(x))]


def feature_table(docs: DataFrame) -> DataFrame:
    """doc_id and x (the statistics) of each document."""
    def one(piece: pa.RecordBatch) -> pa.RecordBatch:
        x = statistics(piece.column("text"))
        flat = pa.array(x.reshape(-1))
        offs = pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32))
        return pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.ListArray.from_arrays(offs, flat)], ["doc_id", "x"])

    return documents(docs).mapInArrow(lambda b: in_pieces(b, one), "doc_id long, x array<double>")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _sums(rows: DataFrame, of, size: int) -> np.ndarray:
    """Sum over all rows of of(x, y), an array of (k, size): each partition emits its k sums, which are added by row."""
    def part(batches):
        total = None
        for b in batches:
            if b.num_rows:
                s = of(_matrix(b), b.column("y").to_numpy(zero_copy_only=False).astype(float))
                total = s if total is None else total + s
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(list(total))], ["i", "v"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for i, v in zip(b.column("i").to_pylist(), b.column("v")):
                v = np.asarray(v.values)
                total[i] = total[i] + v if i in total else v
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array(list(total.values()))], ["i", "v"])

    shape = "i long, v array<double>"
    got = rows.mapInArrow(part, shape).repartition("i").mapInArrow(add, shape).collect()  # k rows, whatever the input
    out = np.zeros((max((r.i for r in got), default=-1) + 1, size))
    for r in got:
        out[r.i] = r.v
    return out


def isotonic(good: np.ndarray, all_: np.ndarray) -> np.ndarray:
    """Pool adjacent violators over bins; empty bins take the value of the block before them."""
    blocks: list[list[float]] = []  # good, rows, bins
    for g, t in zip(good, all_):
        blocks.append([g, t, 1])
        while len(blocks) > 1 and (blocks[-1][1] == 0 or blocks[-2][1] == 0
                                   or blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]):
            b = blocks.pop()
            blocks[-1] = [x + y for x, y in zip(blocks[-1], b)]
    # half a pseudo row per class keeps the values off 0 and 1; the order of blocks may not turn over it
    values = np.maximum.accumulate([(g + 0.5) / (t + 1) for g, t, _ in blocks])
    return np.repeat(values, [int(b[2]) for b in blocks])


def fit(labelled: DataFrame, dim: int = 256, width: float = 6.0, ridge: float = 1e-3, bins: int = 512,
        seed: int = 7) -> Model:
    """Fit on a table of (x, y): statistics and label 0 or 1."""
    k = len(FEATURES)
    rows = cut(labelled.select("x", F.col("y").cast("double").alias("y")))
    moments = _sums(rows, lambda x, y: np.stack([x.sum(0), (x * x).sum(0), np.full(k, len(x)), np.full(k, y.sum())]), k)
    n, good = (moments[2, 0], moments[3, 0]) if len(moments) else (0.0, 0.0)
    rng = np.random.default_rng(seed)
    weights, phase = rng.normal(size=(k, dim)) / width, rng.uniform(0, 2 * np.pi, dim)
    if not 0 < good < n:
        share = 0.5 if n == 0 else good / n
        return Model(np.zeros(k), np.ones(k), weights, phase, np.zeros(dim + 1), 0.0, 1.0, np.full(bins, share))
    mean = moments[0] / n
    scale = np.sqrt(np.maximum(moments[1] / n - mean ** 2, 1e-12))
    scale[scale < 1e-5] = 1.0
    model = Model(mean, scale, weights, phase, np.zeros(dim + 1), 0.0, 1.0, np.zeros(bins))

    def normal(x, y):
        z = model.features(x)
        return np.concatenate([z.T @ z, (z.T @ y)[:, None]], axis=1)

    eq = _sums(rows, normal, dim + 2)
    a, b = eq[:, :-1], eq[:, -1]
    model.coef = np.linalg.solve(a + ridge * n / dim * np.eye(dim + 1), b)
    model.low, model.high = -0.5, 1.5

    def histogram(x, y):
        at = model.bin(model.raw(x))
        return np.stack([np.bincount(at, weights=y, minlength=bins), np.bincount(at, minlength=bins)])

    counts = _sums(rows, histogram, bins)
    model.calibrated = isotonic(counts[0], counts[1])
    return model


def held_out(doc_id) -> F.Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0


def training_rows(docs: DataFrame, labels: DataFrame, learn=None) -> DataFrame:
    """(x, y) of the labelled documents for which ``learn`` holds (a condition on doc_id)."""
    return labelled(feature_table(docs), labels, learn)


def labelled(x: DataFrame, labels: DataFrame, learn=None) -> DataFrame:
    """(x, y) of the labelled rows of a feature table.

    The statistics (some bytes a document) are joined with the labels, not the texts."""
    y = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("y")).filter(
        "doc_id is not null and y is not null")
    if learn is not None:
        x, y = x.filter(learn(F.col("doc_id"))), y.filter(learn(F.col("doc_id")))
    return x.join(y, "doc_id").select("x", "y")


def scores(features: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of each row of a feature table."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(model.score(_matrix(b)))], ["doc_id", "score"])

    return features.mapInArrow(run, "doc_id long, score double")


def good_documents(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` (all columns) whose score reaches the threshold; the text travels through the tasks, not a shuffle."""
    name = free_name(docs, "_text")

    def run(batches):
        for piece in pieces(batches, column=name):
            keep = model.score(statistics(piece.column(name))) >= threshold
            yield piece.filter(pa.array(keep)).drop_columns([name])

    return docs.withColumn(name, F.col("text").cast("string")).mapInArrow(run, docs.schema)
