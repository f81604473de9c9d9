"""Exact top-k inner products by score-at-a-time over impact-ordered segments.

Vectors become integers, floor(256 x).  The queries travel in batches of at
most ``batch_bytes`` to all tasks, so a broadcast is bounded whatever their
number; rows are read once per batch and are never shuffled.

A task takes its rows in blocks.  A block's index has, for each dimension,
segments of rows of about equal component value (``levels`` quantised values;
a segment knows its smallest and largest one).  For a query, the impact of a
segment is the largest gain of its rows over the dimension's least
contribution; segments are processed by descending impact, in steps (after
half of the postings only for rows that are still possible).  After a step
each row has a lower and an upper bound of its score.  Processing stops
only when fewer than a few rows could still reach the k-th best score known
(from lower bounds and from earlier blocks), or at the end; the rows that
could are rescored exactly.  Each task emits k rows per query, and a window
over those takes the best k.

Cases: rows whose id or vector is null, or with a null or non-finite
component, take no part; vectors of different lengths count as padded with
zeros; candidates are all rows with another id than the query's; repeated
rows are candidates as often as they occur, and equal queries search once;
scores beyond 64 bits are held at its limits, and scaled components beyond
1e150 at that; ties go to the smaller id; an
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinlake.llm.common import cut

SCALE = 256
HUGE = 1e150  # products of two, and sums of those, are still doubles


def vectors(df: DataFrame) -> DataFrame:
    """vec_id (long) and embedding (array of double) of the rows that take part."""
    e = F.col("embedding").cast("array<double>")
    fine = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("embedding")).filter(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine)


def integers(lists: pa.Array, dim: int) -> np.ndarray:
    """floor(256 x) of each row, as whole doubles, padded with zeros to ``dim``."""
    with np.errstate(over="ignore"):
        values = np.floor(SCALE * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).clip(-HUGE, HUGE)
    size = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(size), max(dim, int(size.max(initial=0)))))
    out[np.repeat(np.arange(len(size)), size), np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)] = values
    return out


def exact(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Integer inner products."""
    top = np.abs(rows).max(initial=0) * np.abs(query).max(initial=0) * max(1, len(query))
    if top < 1 << 53:
        return (rows @ query).astype(np.int64)  # all partial sums are whole numbers a double holds
    low, high = -(1 << 63), (1 << 63) - 1
    q = [int(x) for x in query]
    return np.array([min(max(sum(int(a) * b for a, b in zip(r, q)), low), high) for r in rows], np.int64)


class Block:
    """Impact-ordered segments of up to a few thousand rows."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, levels: int = 32):
        self.ids, self.rows = ids, rows
        n, dim = rows.shape
        self.low, self.high = rows.min(0), rows.max(0)
        width = np.maximum(self.high - self.low, 1) / levels
        level = np.minimum(((rows - self.low) / width).astype(np.int64), levels - 1)
        self.cell = (np.arange(dim) * levels + level).astype(np.int32)  # the segment of each row and dimension
        key = self.cell.T.reshape(-1)  # by dimension, then row
        order = np.argsort(key, kind="stable")
        self.post = (order % n).astype(np.int64)
        bounds = np.searchsorted(key[order], np.arange(dim * levels + 1))
        self.full = np.flatnonzero(np.diff(bounds))
        self.start, self.size = bounds[self.full], np.diff(bounds)[self.full]
        self.dim = np.repeat(np.arange(dim), levels)
        value = rows.T.reshape(-1)[order]
        self.least, self.most = np.zeros(dim * levels), np.zeros(dim * levels)
        if len(self.full):
            self.least[self.full] = np.minimum.reduceat(value, self.start)
            self.most[self.full] = np.maximum.reduceat(value, self.start)

    def postings(self, part: np.ndarray) -> np.ndarray:
        """Rows of the segments ``part`` (ascending), copied in runs of neighbours."""
        start, end = self.start[part], self.start[part] + self.size[part]
        gap = np.flatnonzero(start[1:] != end[:-1])
        return np.concatenate([self.post[a:b] for a, b in zip(start[np.r_[0, gap + 1]].tolist(), end[np.r_[gap, -1]].tolist())])

    def known_scores(self, queries: np.ndarray, ids: np.ndarray, k: int, rows: int = 512) -> np.ndarray:
        """The k-th best exact score of each query among the first ``rows`` rows (-inf: not known)."""
        some, own = self.rows[:rows], self.ids[:rows]
        if len(own) <= k or not len(ids) or np.abs(some).max() * np.abs(queries).max() * queries.shape[1] >= 1 << 53:
            return np.full(len(ids), -np.inf)
        out = []
        for at in range(0, len(ids), 1024):
            scores = np.where(ids[at:at + 1024, None] == own, -np.inf, queries[at:at + 1024] @ some.T)
            out.append(np.partition(scores, len(own) - k, axis=1)[:, len(own) - k])
        return np.concatenate(out)

    def candidates(self, query: np.ndarray, own: int, k: int, known: float, steps: int = 2) -> np.ndarray:
        """Rows that may be among the best k with a score of at least ``known``, by bounds from segments.

        The first three fifths of the postings, in segments of descending impact, go to all rows' accumulators; the
        remaining segments are processed in ``steps`` and only for the rows that are still possible.  Where ``known``
        is a score, rows are held against it and need no lower bounds."""
        n, dim = self.rows.shape
        floor = np.minimum(query * self.low, query * self.high)  # least contribution of each dimension
        base = floor.sum()
        a, b = query[self.dim] * self.least - floor[self.dim], query[self.dim] * self.most - floor[self.dim]
        gain_low, gain_high = np.minimum(a, b), np.maximum(a, b)
        order = np.argsort(-gain_high[self.full], kind="stable")
        impact = self.full[order]  # segments by descending impact
        slack = 1e-9 * (np.abs(floor).sum() + gain_high.sum() + 1)
        first = int(np.searchsorted(np.cumsum(self.size[order]), n * dim * 0.6)) + 1
        stops = np.unique(np.linspace(first, len(impact), steps + 1).astype(int)) if len(impact) > first else [len(impact)]
        bounded = known > -np.inf
        done = np.zeros(len(gain_high), bool)
        alive = np.flatnonzero(self.ids != own)
        for i, stop in enumerate(stops):
            done[impact[:stop]] = True
            # what a dimension can still add to a row that it has not met: its next segment's gain
            rest = np.zeros(dim)
            np.maximum.at(rest, self.dim[impact[stop:]], gain_high[impact[stop:]])
            if i == 0:  # postings of the segments, for all rows
                part = np.sort(order[:stop])
                size, seg, rows = self.size[part], self.full[part], self.postings(part)
                low = None if bounded else base + np.bincount(rows, np.repeat(gain_low[seg], size), n)[alive]
                high = base + rest.sum() + np.bincount(rows, np.repeat(gain_high[seg] - rest[self.dim[seg]], size), n)[alive]
            else:
                cells = self.cell[alive]
                low = None if bounded else base + np.where(done, gain_low, 0.0).take(cells).sum(axis=1)
                high = base + np.where(done, gain_high, rest[self.dim]).take(cells).sum(axis=1)
            floor_k = known
            if not bounded and len(alive) >= k:
                floor_k = max(known, np.partition(low, len(alive) - k)[len(alive) - k])
            alive = alive[high + slack >= floor_k - slack]
            if len(alive) <= 4 * k:  # proof: no other row can be among the best
                break
        return alive


def _search(ids: np.ndarray, queries: np.ndarray, k: int, block_rows: int):
    def run(batches):
        best: list[list[tuple[int, int]]] = [[] for _ in ids]  # (-score, vec_id), ascending

        def take(block: Block) -> None:
            dim = block.rows.shape[1]
            asked = np.zeros((len(ids), dim))
            asked[:, :min(dim, queries.shape[1])] = queries[:, :dim]
            known_here = block.known_scores(asked, ids, k) if any(len(x) < k for x in best) else None
            for i, own in enumerate(ids):
                q = asked[i]
                known = -best[i][-1][0] if len(best[i]) == k else known_here[i]
                rows = block.candidates(q, own, k, known)
                found = [(-int(s), int(v)) for s, v in zip(exact(block.rows[rows], q), block.ids[rows]) if s >= known]
                if found:
                    best[i] = sorted(best[i] + found)[:k]

        held: list[pa.RecordBatch] = []
        rows = 0

        def flush() -> None:
            nonlocal held, rows
            if rows:
                t = pa.Table.from_batches(held).combine_chunks()
                e = t["embedding"].chunk(0)
                take(Block(t["vec_id"].to_numpy(), integers(e, 1)))
            held, rows = [], 0

        for b in batches:
            for at in range(0, b.num_rows, block_rows):
                part = b.slice(at, block_rows)
                if rows + part.num_rows > block_rows:
                    flush()
                held.append(part)
                rows += part.num_rows
        flush()
        out = [(int(q), v, -s) for q, x in zip(ids, best) for s, v in x]
        for at in range(0, len(out), 10_000):
            part = out[at:at + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in part], pa.int64()) for j in range(3)],
                                             ["query_id", "vec_id", "score"])

    return run


def top_k(queries: DataFrame, rows: DataFrame, k: int = 5, block_rows: int = 4096, batch_bytes: int = 16 << 20) -> DataFrame:
    """query_id, rank, vec_id and score of the best k rows for every query (tables of vec_id, embedding)."""
    asked = cut(vectors(queries).distinct())
    size = asked.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("dim")).first()
    batches = max(1, -(-size.n * 8 * max(size.dim or 1, 1) // batch_bytes))
    found = None
    for i in range(batches):
        own = asked if batches == 1 else asked.filter(F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(batches)) == i)
        t = own.toArrow().combine_chunks()
        ids = t["vec_id"].to_numpy()
        matrix = integers(t["embedding"].chunk(0), 1) if len(ids) else np.zeros((0, 1))
        part = vectors(rows).mapInArrow(_search(ids, matrix, k, block_rows), "query_id long, vec_id long, score long")
        found = part if found is None else found.unionAll(part)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
