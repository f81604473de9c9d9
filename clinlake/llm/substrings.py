"""Substring dedup by Relative Lempel-Ziv parsing against an index of reference blocks.

A word goes if a window of ``window`` consecutive words that covers it also
starts earlier (in a smaller document id, or earlier in the same document).
All documents are the reference, and each is factored against all of it.

Reference blocks.  Of the ``k``-word hashes in a window the smallest one is the
window's anchor.  Consecutive windows with one anchor form a block; anchors and
block borders depend on the content alone, so equal passages are cut equally.
A block is indexed by its anchor, with a hash of its words.

1. Factors.  A block that also stands earlier continues a factor: all its
   windows are duplicates, found by the index alone.  A run of such blocks is
   the greedy factor.
2. Factor boundaries.  Where a factor begins or ends inside a block, the block
   differs from all others but shares its anchor with some.  Its windows are
   compared one by one, by 128-bit hashes, with those of the first copy of
   every other block of that anchor.  (A window equal to an earlier one has
   the same anchor at the same distance, so nothing is missed.)
3. Factors of at least ``window`` words are thereby known as ranges of window
   starts, which go back to their documents; the words they cover are removed.

Hot content.  A task works through its documents in pieces and sends one row
per distinct block (or window) of a piece; the other copies in the piece are
known duplicates and go straight to step 3.  A piece also sends at most
``spread`` blocks of one anchor to the index: the rest go straight to step 2
with one marker row that makes the anchor's other blocks do the same.  So the
rows that meet in one group grow with the number of pieces, not with the
number of copies.

Cases: a null text has no words; rows without an id take no part; texts of
fewer than ``window`` words lose nothing; rows that repeat an id are joined
into one document, their texts in sorted order one after the other (exact
repetitions count once); an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinlake.llm.common import Rolling, WordArray, covered, cut, documents, in_pieces, mix, signed, sliding_argmin

WINDOW, K, SPREAD = 20, 6, 16
BASE2 = 0xD6E8FEB86659FD93
PIECE = 4 << 20


class Blocks:
    """The windows of a piece of texts, in blocks of one anchor; starts are places among all words of the piece."""

    def __init__(self, texts: pa.Array, window: int, k: int):
        w = self.words = WordArray(texts)
        self.doc = w.doc_of()
        end = np.repeat(w.off[1:], w.counts())
        self.one, self.two = Rolling(w.hashes(0)), Rolling(w.hashes(1), BASE2)
        self.starts = np.flatnonzero(np.arange(w.n) + window <= end)
        none = np.zeros(0, np.int64)
        self.low = self.high = self.anchor_at = none
        self.anchor = self.body = np.zeros(0, np.uint64)
        if not len(self.starts):
            return
        at = np.arange(w.n - k + 1)
        grams = mix(self.one.run(at, at + k))
        kept = sliding_argmin(grams, window - k + 1)[self.starts]
        new = np.concatenate([[True], (kept[1:] != kept[:-1]) | (np.diff(self.starts) != 1)])
        self.low = self.starts[new]  # first and last window start of each block
        self.high = self.starts[np.append(np.flatnonzero(new)[1:], len(self.starts)) - 1]
        self.anchor_at = kept[new]
        self.anchor = grams[self.anchor_at]
        stop = self.high + window
        place = (self.anchor_at - self.low).astype(np.uint64)
        self.body = mix(self.one.run(self.low, stop) + mix(self.two.run(self.low, stop)) + place * np.uint64(0x9E3779B97F4A7C15))

    def own(self, places: np.ndarray) -> np.ndarray:
        """Places counted from the start of their document."""
        return places - self.words.off[self.doc[places]]


def _first_of_each(keys: list[np.ndarray], ids: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (keys, id, start), and in that order: is this the first row of its keys?"""
    order = np.lexsort((start, ids, *keys[::-1]))
    first = np.ones(len(order), bool)
    same = np.ones(max(len(order) - 1, 0), bool)
    for key in keys:
        s = key[order]
        same &= s[1:] == s[:-1]
    first[1:] = ~same
    return order, first


INDEX = "route long, body long, doc_id long, low int, high int, state int"
# states: to be compared by its anchor; a marker of a busy anchor; a known duplicate; to be compared by windows
COMPARE, MARKER, DUPLICATE, WINDOWS = 0, 1, 2, 3


def _index(window: int, k: int, spread: int):
    def one(piece: pa.RecordBatch) -> pa.RecordBatch | None:
        b = Blocks(piece.column("text"), window, k)
        if not len(b.low):
            return None
        ids = piece.column("doc_id").to_numpy()[b.doc[b.low]]
        low, high = b.own(b.low), b.own(b.high)
        order, first = _first_of_each([b.anchor, b.body], ids, low)
        state = np.where(first, COMPARE, DUPLICATE)
        # number of distinct blocks of the same anchor before this one
        anchor = b.anchor[order]
        new = np.concatenate([[True], anchor[1:] != anchor[:-1]])
        count = np.cumsum(first)
        nth = count - np.maximum.accumulate(np.where(new, count, 0))
        busy = first & (nth >= spread)
        state[busy] = WINDOWS
        # only rows to be compared go by their anchor; the others are dealt out evenly
        loose = mix(ids[order].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + low[order].astype(np.uint64))
        route = np.where(state == COMPARE, anchor, loose)
        marks = np.unique(anchor[busy])
        n = len(marks)
        return pa.RecordBatch.from_arrays([
            pa.array(signed(np.concatenate([route, marks]))), pa.array(signed(np.concatenate([b.body[order], np.zeros(n, np.uint64)]))),
            pa.array(np.concatenate([ids[order], np.zeros(n, np.int64)])),
            pa.array(np.concatenate([low[order], np.zeros(n, np.int64)]).astype(np.int32)),
            pa.array(np.concatenate([high[order], np.zeros(n, np.int64)]).astype(np.int32)),
            pa.array(np.concatenate([state, np.full(n, MARKER)]).astype(np.int32))],
            ["route", "body", "doc_id", "low", "high", "state"])

    return lambda batches: in_pieces(batches, one, PIECE)


def factors(docs: DataFrame, window: int = WINDOW, k: int = K, spread: int = SPREAD) -> DataFrame:
    """doc_id, low, high (window starts) and state (duplicate, or to be compared by windows) of blocks, after step 1."""
    rows = docs.mapInArrow(_index(window, k, spread), INDEX).repartition("route")  # serves all windows below
    # Rows of one route: at most ``spread`` and a marker from each piece.
    by_route = Window.partitionBy("route")
    nth = F.row_number().over(Window.partitionBy("route", "state", "body").orderBy("doc_id", "low"))
    compared = rows.withColumn("nth", nth).withColumns({
        "least": F.min("body").over(by_route), "most": F.max("body").over(by_route),
        "marked": F.max((F.col("state") == MARKER).cast("int")).over(by_route)})
    state = F.when(F.col("state") != COMPARE, F.col("state")).when(F.col("nth") > 1, DUPLICATE).when(
        (F.col("least") != F.col("most")) | (F.col("marked") == 1), WINDOWS)
    return compared.select("doc_id", "low", "high", state.alias("state")).filter(F.col("state").isin(DUPLICATE, WINDOWS))


WINDOW_ROWS = "a long, b long, doc_id long, low int, high int, known boolean"


def _windows(window: int, k: int):
    def one(piece: pa.RecordBatch) -> pa.RecordBatch | None:
        w = WordArray(piece.column("text"))
        ranges = piece.column("ranges")
        doc = np.repeat(np.arange(piece.num_rows), pc.list_value_length(ranges).to_numpy())
        flat = ranges.flatten()
        low = flat.field("low").to_numpy().astype(np.int64)
        size = flat.field("high").to_numpy() - low + 1
        n = int(size.sum())
        if not n:
            return None
        owner = np.repeat(doc, size)
        place = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(n)
        at = place + w.off[owner]
        a, b = Rolling(w.hashes(0)).run(at, at + window), Rolling(w.hashes(1), BASE2).run(at, at + window)
        ids = piece.column("doc_id").to_numpy()[owner]
        order, first = _first_of_each([a, b], ids, place)
        ids, place, a, b = ids[order], place[order], a[order], b[order]
        # copies inside the piece are known; runs of them are one row
        i, p = ids[~first], place[~first]
        again = np.lexsort((p, i))
        i, p = i[again], p[again]
        new = np.concatenate([[True], (np.diff(i) != 0) | (np.diff(p) != 1)]) if len(i) else np.zeros(0, bool)
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(i)) - 1 if len(i) else heads
        m = len(heads)
        spread_key = mix(i[heads].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + p[heads].astype(np.uint64))
        return pa.RecordBatch.from_arrays([
            pa.array(signed(np.concatenate([a[first], spread_key]))), pa.array(signed(np.concatenate([b[first], np.zeros(m, np.uint64)]))),
            pa.array(np.concatenate([ids[first], i[heads]])), pa.array(np.concatenate([place[first], p[heads]]).astype(np.int32)),
            pa.array(np.concatenate([place[first], p[tails]]).astype(np.int32)),
            pa.array(np.concatenate([np.zeros(first.sum(), bool), np.ones(m, bool)]))],
            ["a", "b", "doc_id", "low", "high", "known"])

    return lambda batches: in_pieces(batches, one, PIECE)


def boundary_duplicates(docs: DataFrame, blocks: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """doc_id, low, high of the windows in ``blocks`` that also start earlier."""
    per_doc = blocks.groupBy("doc_id").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))  # a document's own
    rows = docs.join(per_doc, "doc_id").select("doc_id", "text", "ranges").mapInArrow(_windows(window, k), WINDOW_ROWS)
    # rows of one window: at most one from each piece
    nth = F.row_number().over(Window.partitionBy("a", "b", "known").orderBy("doc_id", "low"))
    return rows.withColumn("nth", nth).filter("known or nth > 1").select("doc_id", "low", "high")


def _removed(window: int, texts: bool):
    def one(piece: pa.RecordBatch) -> pa.RecordBatch:
        w = WordArray(piece.column("text"))
        ranges = piece.column("ranges")
        flat = ranges.flatten()
        doc = np.repeat(np.arange(piece.num_rows), pc.fill_null(pc.list_value_length(ranges), 0).to_numpy(zero_copy_only=False))
        low = flat.field("low").to_numpy(zero_copy_only=False).astype(np.int64)
        high = flat.field("high").to_numpy(zero_copy_only=False).astype(np.int64)
        gone = covered(low + w.off[doc], high + w.off[doc] + window, w.n) if len(low) else np.zeros(w.n, bool)
        vocab = np.asarray(w.vocab.to_pylist(), dtype=object)
        kept, removed = [], []
        for a, b in zip(w.off[:-1], w.off[1:]):
            out = gone[a:b]
            removed.append(int(out.sum()))
            kept.append(" ".join(vocab[w.codes[a:b][~out]]) if b > a else "")
        last = pa.array(kept, pa.string()) if texts else pa.array([hashlib.sha256(t.encode()).hexdigest() for t in kept])
        return pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(w.counts()), pa.array(removed, pa.int64()), last],
                                          ["doc_id", "n_words", "n_removed", "kept"])

    return lambda batches: in_pieces(batches, one, PIECE)


def whole_documents(docs: DataFrame) -> DataFrame:
    """One row per id.  Texts are only moved if some id repeats."""
    rows = documents(docs)
    repeated = cut(rows.groupBy("doc_id").count().filter("count > 1").select("doc_id"))
    if repeated.isEmpty():
        return rows
    again = rows.join(repeated, "doc_id").groupBy("doc_id").agg(
        F.array_join(F.array_sort(F.collect_set(F.coalesce("text", F.lit("")))), " ").alias("text"))
    return rows.join(repeated, "doc_id", "left_anti").unionAll(again)


def duplicate_ranges(docs: DataFrame, window: int = WINDOW, k: int = K, spread: int = SPREAD) -> DataFrame:
    """doc_id, low, high: ranges of window starts whose windows also start earlier (ids of ``docs`` are distinct)."""
    found = cut(factors(docs, window, k, spread))
    inside = found.filter(F.col("state") == DUPLICATE).select("doc_id", "low", "high")
    return inside.unionAll(boundary_duplicates(docs, found.filter(F.col("state") == WINDOWS), window, k))


def remove_repeats(docs: DataFrame, window: int = WINDOW, k: int = K, spread: int = SPREAD, texts: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the kept words joined by spaces, or with ``texts=False`` its sha256)."""
    ranges = cut(duplicate_ranges(docs, window, k, spread).groupBy("doc_id").agg(F.collect_list(F.struct("low", "high")).alias("ranges")))
    return docs.join(ranges, "doc_id", "left").select("doc_id", "text", "ranges").mapInArrow(
        _removed(window, texts), "doc_id long, n_words long, n_removed long, kept string")
