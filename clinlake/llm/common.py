"""Helpers shared by the operators: table access, shared storage and word arrays.

Word arrays.  A task receives Arrow batches.  ``pieces`` cuts them into
pieces of bounded text size, and ``WordArray`` turns one piece into flat
numpy arrays: one 64-bit hash per word plus the offsets of each document.
Words are ``[^\\x20\\x09-\\x0D]+`` (Arrow's ASCII white-space split), after an
optional byte mapping.  Equal words have equal hashes, and sequences of words
are compared by rolling polynomials over those hashes (``Rolling``).
"""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PIECE_BYTES = 4 << 20  # text handled at a time inside a task


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir`` (set locally only where it is unset)."""
    from clinlake.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, and a lost
    executor costs a reread of files instead of a recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def per_worker(key: str, build: Callable[[], object]) -> object:
    """``build()``, made once in a Python worker process and kept for its later tasks (code that travels by
    value starts every task with fresh globals).  Only the last object of a kind (the key up to ``:``) stays."""
    kept = sys.modules.setdefault("_clinlake_worker", types.ModuleType("_clinlake_worker")).__dict__
    if key not in kept:
        kind = key.partition(":")[0] + ":"
        for old in [k for k in kept if k.startswith(kind)]:
            del kept[old]
        kept[key] = build()
    return kept[key]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column that tells its rows apart, and that column's name.

    The id does, where no row lacks it and none repeats it; otherwise rows are numbered and written, since a task
    that runs again must find the same numbers."""
    key, doc_id = free_name(docs, "_row"), F.col("doc_id").cast("long")
    ids = docs.groupBy(doc_id.alias("i")).agg(F.count(F.lit(1)).alias("n"))
    if ids.filter("i is null or n > 1").isEmpty():
        return docs.withColumn(key, doc_id), key
    return cut(docs.withColumn(key, F.monotonically_increasing_id())), key


def without(docs: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``key`` is not among those of ``gone`` (one column), without the key."""
    other = free_name(docs, "_gone")
    return docs.join(gone.toDF(other).hint("merge"), docs[key] == F.col(other), "left_anti").drop(key)


def documents(df: DataFrame, *keep: str, id_col: str = "doc_id", text_col: str = "text", every: bool = False) -> DataFrame:
    """The id (long) and text (string) columns of ``df`` (and ``keep``); rows without an id only take part with ``every``."""
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *keep)
    return rows if every else rows.filter(F.col("doc_id").isNotNull())


def pieces(batches: Iterator[pa.RecordBatch], limit: int = PIECE_BYTES, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of the batches holding about ``limit`` bytes of text (one longer text is a slice of its own)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start, base = 0, 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(size, base + limit, side="right")))
            yield batch.slice(start, end - start)
            base, start = int(size[end - 1]), end


def in_pieces(batches: Iterator[pa.RecordBatch], fn, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Apply ``fn(piece) -> RecordBatch | None`` to every piece."""
    for piece in pieces(batches, limit):
        out = fn(piece)
        if out is not None and out.num_rows:
            yield out


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts (null: empty) and the n+1 offsets of the texts in them."""
    texts = pc.fill_null(texts, "")
    if pa.types.is_large_string(texts.type):
        kind = np.int64
    else:
        texts, kind = texts.cast(pa.string()), np.int32
    off = np.frombuffer(texts.buffers()[1], dtype=kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def byte_strings(values: pa.Array) -> list[bytes]:
    """The values of a binary array without nulls (many times faster than ``to_pylist``)."""
    data, off = text_bytes(values.cast(pa.large_binary()).view(pa.large_string()))
    data, off = data.tobytes(), off.tolist()
    return [data[a:b] for a, b in zip(off, off[1:])]


def mapped(texts: pa.Array, byte_map: np.ndarray) -> pa.Array:
    """The texts with each byte replaced by ``byte_map`` (which keeps bytes above 0x7F)."""
    data, off = text_bytes(texts)
    return pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(off.astype(np.int64).tobytes()),
                                                                pa.py_buffer(byte_map[data].tobytes())]).view(pa.large_string())


def ascii_lower_map() -> np.ndarray:
    m = np.arange(256, dtype=np.uint8)
    m[65:91] += 32
    return m


class WordArray:
    """Words of a piece of texts: ``codes`` index ``vocab``; document i has words off[i]..off[i+1]."""

    def __init__(self, texts: pa.Array, byte_map: np.ndarray | None = None):
        texts = pc.fill_null(texts, "") if byte_map is None else mapped(texts, byte_map)
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten()
        bounds = split.offsets.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        real = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
        count = np.zeros(len(real) + 1, np.int64)
        np.cumsum(real, out=count[1:])
        self.off = count[bounds]
        coded = words.filter(pa.array(real)).dictionary_encode()
        self.vocab: pa.Array = coded.dictionary
        self.codes = coded.indices.to_numpy(zero_copy_only=False)
        self.n = len(self.codes)

    def counts(self) -> np.ndarray:
        return np.diff(self.off)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.off) - 1), self.counts())

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word."""
        h = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in self.vocab.to_pylist()), np.uint64, len(self.vocab))
        return h[self.codes] if self.n else np.zeros(0, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Rolling:
    """Hashes of runs of words, by prefix sums of h[i] * R^i modulo 2^64 (R odd)."""

    def __init__(self, hashes: np.ndarray, base: int = 0x9E3779B97F4A7C15 | 5):
        n = len(hashes)
        base |= 1
        self.inverse = self._powers(pow(base, -1, 1 << 64), n + 1)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * self._powers(base, n), out=self.prefix[1:])

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.empty(max(n, 1), np.uint64)
        out[0] = 1
        done, step = 1, base
        while done < n:  # out[done + i] = out[i] * base^done
            take = min(done, n - done)
            out[done:done + take] = out[:take] * np.uint64(step)
            done += take
            step = step * step % (1 << 64)
        return out[:n]

    def run(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of words start..end-1, for arrays of starts and ends."""
        return mix((self.prefix[end] - self.prefix[start]) * self.inverse[start] + (end - start).astype(np.uint64))


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """For each i, the leftmost position of the smallest of values[i : i + width]."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best = np.arange(len(values), dtype=np.int64)
    span = 1
    while span < width:  # best[i] covers values[i : i + span]
        step = min(span, width - span)
        a, b = best[:-step], best[step:]
        best = np.where(values[b] < values[a], b, a)
        span += step
    return best[:n]


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in any of the ranges start..end-1."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends, -1)
    return np.cumsum(edge[:-1]) > 0


class UnitCache:
    """Ids of distinct units (byte strings), encoded once each and remembered up to ``limit`` units.

    ``encode_many`` turns a list of units into flat ids and the n+1 offsets of the units in them."""

    def __init__(self, encode_many, limit: int = 300_000):
        self.encode_many, self.limit = encode_many, limit
        self._reset()

    def _reset(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.start, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32)

    @staticmethod
    def _room(a: np.ndarray, n: int) -> np.ndarray:
        return a if n <= len(a) else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])

    def ids(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all units in their order, and the n+1 offsets of the units in them."""
        coded = units.dictionary_encode()
        vocab = byte_strings(coded.dictionary)
        place = list(map(self.known.get, vocab))
        new = [u for u, i in zip(vocab, place) if i is None]
        if len(self.known) + len(new) > self.limit:
            self._reset()
            new = vocab
        if new:
            flat, off = self.encode_many(new)
            a, b = len(self.known), len(self.known) + len(new)
            self.flat = self._room(self.flat, self.used + len(flat))
            self.start, self.size = self._room(self.start, b), self._room(self.size, b)
            self.flat[self.used:self.used + len(flat)] = flat
            self.start[a:b], self.size[a:b] = self.used + off[:-1], np.diff(off)
            self.used += len(flat)
            self.known.update(zip(new, range(a, b)))
            place = list(map(self.known.__getitem__, vocab))
        unit = np.array(place, np.int64)
        unit = unit[coded.indices.to_numpy(zero_copy_only=False)] if len(vocab) else unit
        return gather(self.flat, self.start[unit], self.size[unit])


def gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs flat[start : start + size] one after the other, and their n+1 offsets."""
    off = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=off[1:])
    return flat[np.repeat(start - off[:-1], size) + np.arange(off[-1])], off
