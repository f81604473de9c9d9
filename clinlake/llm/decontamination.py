"""Benchmark decontamination by winnowing.

Fingerprints: the hash of every run of ``k`` words; of every ``window - k + 1``
consecutive ones the smallest is kept, so every run of ``window`` words keeps
at least one fingerprint, chosen by its content alone.  A benchmark window and
its copy in a document therefore keep the same fingerprint at the same place.

1. The benchmark is fingerprinted into an index: the kept fingerprints and the
   128-bit hashes of all its windows, with the item of each.  An item of fewer
   than ``window`` words, but not none, is one window of its own length; those
   are looked up at every place of a document.
2. The index is cut into blocks of at most ``block_windows`` windows, and each
   block is shipped to the tasks.  Its size is thereby bounded whatever the
   benchmark's size; documents are read once per block.
3. A task winnows its documents, keeps the fingerprints found in the block,
   and extends each hit: the windows that keep this fingerprint are compared
   by their 128-bit hashes.  The extended hits are ranges of words.

Cases: a null text has no words; rows without a document id take no part; an
item without words matches nothing; repeated items and repeated documents
count as often as they occur in the result of documents, and once as an item;
an empty benchmark hits nothing; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.llm.common import (Rolling, WordArray, ascii_lower_map, covered, documents, in_pieces, keyed, mix,
                                 sliding_argmin, without)

WINDOW, K = 10, 4
BASE2 = 0xD6E8FEB86659FD93


def word_map() -> np.ndarray:
    """A-Z lower-cased; ASCII other than letters and digits becomes a space."""
    m = ascii_lower_map()
    ascii_ = np.arange(256) < 128
    word = np.zeros(256, bool)
    word[48:58] = word[97:123] = word[65:91] = True
    m[ascii_ & ~word] = 32
    return m


class Fingerprints:
    """Word hashes of a piece of texts, its windows of ``window`` words and the fingerprint each keeps."""

    def __init__(self, texts: pa.Array, window: int, k: int):
        self.words = WordArray(texts, word_map())
        off, n = self.words.off, self.words.n
        first, second = self.words.hashes(0), self.words.hashes(1)
        self.one, self.two = Rolling(first), Rolling(second, BASE2)
        self.doc = self.words.doc_of()
        self.end = np.repeat(off[1:], np.diff(off))  # end of the document of each word
        self.starts = np.flatnonzero(np.arange(n) + window <= self.end) if n else np.zeros(0, np.int64)
        if len(self.starts):
            at = np.arange(n - k + 1)
            self.grams = mix(self.one.run(at, at + k))
            self.kept = sliding_argmin(self.grams, window - k + 1)[self.starts]
        else:
            self.grams, self.kept = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def keys(self, starts: np.ndarray, length: int) -> np.ndarray:
        out = np.empty(len(starts), dtype=[("a", np.uint64), ("b", np.uint64)])
        out["a"], out["b"] = self.one.run(starts, starts + length), self.two.run(starts, starts + length)
        return out


def benchmark_windows(batches, window: int = WINDOW, k: int = K):
    """Rows (item, length, fingerprint, a, b) of the windows of benchmark items."""
    def one(piece: pa.RecordBatch):
        f = Fingerprints(piece.column("text"), window, k)
        items = np.asarray(piece.column("item").to_pylist(), dtype=object)
        counts = f.words.counts()
        keys = f.keys(f.starts, window)
        cols = [items[f.doc[f.starts]] if len(f.starts) else [], np.full(len(f.starts), window), f.grams[f.kept],
                keys["a"], keys["b"]]
        short = np.flatnonzero((counts > 0) & (counts < window))
        rows = [(items[i], int(counts[i]), f.keys(f.words.off[i:i + 1], int(counts[i]))[0]) for i in short]
        return pa.RecordBatch.from_arrays([
            pa.array([*cols[0], *(r[0] for r in rows)], pa.string()),
            pa.array(np.concatenate([cols[1], [r[1] for r in rows]]).astype(np.int32)),
            pa.array(np.concatenate([cols[2].view(np.int64), np.zeros(len(rows), np.int64)])),
            pa.array(np.concatenate([cols[3], np.array([r[2]["a"] for r in rows], np.uint64)]).view(np.int64)),
            pa.array(np.concatenate([cols[4], np.array([r[2]["b"] for r in rows], np.uint64)]).view(np.int64)),
        ], ["item", "length", "fingerprint", "a", "b"])
    return in_pieces(batches, one)


class Index:
    """One block of the benchmark: its fingerprints, and the items of each window key by length."""

    def __init__(self, rows: pa.Table, window: int):
        length = rows["length"].to_numpy()
        key = np.empty(len(length), dtype=[("a", np.uint64), ("b", np.uint64)])
        key["a"], key["b"] = (rows[c].to_numpy().view(np.uint64) for c in ("a", "b"))
        items = np.asarray(rows["item"].to_pylist(), dtype=object)
        self.fingerprints = np.unique(rows["fingerprint"].to_numpy().view(np.uint64)[length == window])
        self.keys: dict[int, np.ndarray] = {}
        self.items: dict[int, list[np.ndarray]] = {}
        for n in np.unique(length):
            mine = np.flatnonzero(length == n)
            keys, group = np.unique(key[mine], return_inverse=True)
            order = np.argsort(group, kind="stable")
            bounds = np.searchsorted(group[order], np.arange(len(keys) + 1))
            self.keys[int(n)] = keys
            self.items[int(n)] = [items[mine[order[a:b]]] for a, b in zip(bounds[:-1], bounds[1:])]

    def find(self, keys: np.ndarray, length: int) -> np.ndarray:
        """Index of each key among the windows of that length, -1 where it is none."""
        own = self.keys[length]
        at = np.minimum(np.searchsorted(own["a"], keys["a"]), len(own) - 1)
        found = own["a"][at] == keys["a"]
        out = np.where(found & (own["b"][at] == keys["b"]), at, -1)
        for i in np.flatnonzero(found & (out < 0)):  # keys that share their first half only
            j = np.searchsorted(own, keys[i])
            if j < len(own) and own[j] == keys[i]:
                out[i] = j
        return out

    def matches(self, f: Fingerprints, window: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Starts, ends (in words of the piece) and items of all occurring windows."""
        starts, ends, items = [], [], []

        def add(at: np.ndarray, n: int) -> None:
            found = self.find(f.keys(at, n), n)
            starts.append(at[found >= 0])
            ends.append(at[found >= 0] + n)
            items.extend(self.items[n][j] for j in found[found >= 0])

        for n in self.keys:
            if n == window:  # probe the kept fingerprints once each, then extend the hits
                kept = np.unique(f.kept)
                hit = np.zeros(len(f.grams) + 1, bool)
                hit[kept[np.isin(f.grams[kept], self.fingerprints)]] = True
                add(f.starts[hit[f.kept]], n)
            else:
                add(np.flatnonzero(np.arange(f.words.n) + n <= f.end), n)
        none = np.zeros(0, np.int64)
        return np.concatenate(starts or [none]), np.concatenate(ends or [none]), items


def _probe(index: Index | None, window: int, k: int):
    """One pass over the documents: adds the hits of one block to those of the blocks before."""
    def one(piece: pa.RecordBatch) -> pa.RecordBatch:
        f = Fingerprints(piece.column("text"), window, k)
        off = f.words.off
        hit = np.zeros(f.words.n, bool)
        items = [set(x or ()) for x in piece.column("items").to_pylist()]
        for i, ranges in enumerate(piece.column("hits").to_pylist()):
            for r in ranges or ():
                hit[off[i] + r["start"]:off[i] + r["end"]] = True
        if index is not None and f.words.n:
            starts, ends, found = index.matches(f, window)
            hit |= covered(starts, ends, f.words.n)
            for s, names in zip(starts, found):
                items[f.doc[s]].update(names)
        edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
        lo, hi = edge[::2], edge[1::2]
        hits = [[] for _ in range(piece.num_rows)]
        for a, b in zip(lo, hi):  # a run may go on into the next document
            while a < b:
                d = f.doc[a]
                to = min(b, off[d + 1])
                hits[d].append({"start": int(a - off[d]), "end": int(to - off[d])})
                a = to
        out = {"doc_id": piece.column("doc_id"), "text": piece.column("text"),
               "n_words": pa.array(np.diff(off)),
               "hits": pa.array(hits, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
               "items": pa.array([sorted(x) for x in items], pa.list_(pa.string()))}
        return pa.RecordBatch.from_arrays(list(out.values()), list(out))

    return lambda batches: in_pieces(batches, one)


SCHEMA = "doc_id long, text string, n_words long, hits array<struct<start:int,end:int>>, items array<string>"


def benchmark_index(benchmark: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """Distinct (item, window) rows of a benchmark table (item_id, text)."""
    items = documents(benchmark, F.col("item_id").cast("string").alias("item"), id_col="item_id") if \
        dict(benchmark.dtypes)["item_id"] != "string" else benchmark.select(
            F.lit(0).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
            F.col("item_id").alias("item")).filter("item is not null")
    rows = items.select("item", "text").mapInArrow(
        lambda batches: benchmark_windows(batches, window, k), "item string, length int, fingerprint long, a long, b long")
    return rows.distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = K,
                  block_windows: int = 400_000) -> DataFrame:
    """doc_id, text, n_words, hits (ranges of words, merged) and items (ids as strings) of each document."""
    from clinlake.llm.common import cut

    index = cut(benchmark_index(benchmark, window, k))
    blocks = -(-index.count() // block_windows)
    out = documents(docs).withColumns({"n_words": F.lit(0).cast("long"),
                                       "hits": F.lit(None).cast("array<struct<start:int,end:int>>"),
                                       "items": F.lit(None).cast("array<string>")})
    for i in range(max(1, blocks)):
        block = index.filter(F.pmod(F.xxhash64("a", "item"), F.lit(max(1, blocks))) == i).toArrow() if blocks else None
        out = out.mapInArrow(_probe(Index(block, window) if blocks else None, window, k), SCHEMA)
    return out


def digest(found: DataFrame) -> DataFrame:
    """The contract columns of ``contamination``."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + (x["end"] - x["start"]))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` (all columns) in which no benchmark window occurs, each judged by itself."""
    rows, key = keyed(docs)
    bad = contamination(rows.select(F.col(key).alias("doc_id"), "text"), benchmark, window).filter(F.size("hits") > 0).select("doc_id")
    return without(rows, key, bad)
