"""Near-duplicate documents by MinHash and odd sketches, with exact confirmation.

A document's set is its distinct ``shingle``-word shingles (64-bit hashes of
lower-cased words).  Two documents are linked when their sets' Jaccard
similarity reaches ``threshold``.

1. One pass computes each set's 128-bit hash, its MinHash samples folded into
   band keys (``ROWS`` samples a band), and its odd sketch: a bitmap of the
   samples' parities.  Documents of one set are a class, represented by its
   smallest id; only classes go on.
2. Classes that share a band key are candidates.  Inside a bucket, the
   population count of two sketches' XOR estimates how many samples differ;
   pairs beyond the bound for the threshold, or of too different sizes, are
   dropped.  A bucket larger than ``bucket`` classes is cut into blocks, and
   each pair of blocks is a task of its own, so no pair is lost and no group
   is gathered whole.  A bucket gives only a spanning forest of its candidates.
3. Components of the candidates are clusters.  Every set travels to its
   cluster once (clusters beyond ``cluster`` classes or ``cluster_shingles``
   shingles again as pairs of blocks), where intersections are counted exactly
   through posting lists of shingles; the spanning forest of the exact links
   gives the components.

The number of bands and the sketch's bound are computed from the threshold so
that a link is missed with a probability of at most ``miss`` in either.

Cases: a null or empty text or one without words has an empty set and links
with nothing; texts of fewer words have their whole sequence as one shingle;
rows without an id take no part; rows that repeat an id are one document (its
texts count as linked) and are reported each; an empty table gives none; extra
columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.llm.common import (Rolling, WordArray, ascii_lower_map, cut, documents, gather, in_pieces, keyed, mix, signed,
                                 without)
from clinlake.llm.components import components

ROWS = 4
BITS = 512


@dataclass(frozen=True)
class Plan:
    """What follows from a threshold: the number of bands and the largest XOR population count of a link."""

    threshold: Fraction
    shingle: int
    bands: int
    most: int

    @classmethod
    def of(cls, threshold: Fraction, shingle: int, miss: float) -> Plan:
        t = float(threshold)
        bands = math.ceil(math.log(miss) / math.log(1 - t ** ROWS)) if t < 1 else 1
        return cls(threshold, shingle, bands, xor_bound(bands * ROWS, t, miss))


def xor_bound(samples: int, t: float, miss: float) -> int:
    """Least x such that the XOR of two sketches has more than x ones with a probability of at most ``miss``,
    for sets of similarity t: each of Binomial(samples, 1 - t) differing samples flips two random bits."""
    odd = np.zeros(BITS + 1)
    odd[0] = 1
    up = (BITS - np.arange(BITS + 1)) / BITS
    total = np.zeros(BITS + 1)
    for differing in range(samples + 1):
        total += math.comb(samples, differing) * (1 - t) ** differing * t ** (samples - differing) * odd
        for _ in range(2):
            nxt = np.zeros(BITS + 1)
            nxt[1:] += (odd * up)[:-1]
            nxt[:-1] += (odd * (1 - up))[1:]
            odd = nxt
    tail = np.cumsum(total[::-1])[::-1]  # P(ones >= x)
    return int(np.flatnonzero(tail > miss).max(initial=0))


def shingle_sets(texts: pa.Array, shingle: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    w = WordArray(texts, ascii_lower_map())
    roll = Rolling(w.hashes())
    n = w.counts()
    at = np.arange(w.n)
    end = np.repeat(w.off[1:], n)
    short = np.repeat(n < shingle, n)
    stop = np.where(short, end, at + shingle)
    first = np.repeat(w.off[:-1], n)
    is_start = (stop <= end) & (~short | (at == first))
    starts = at[is_start]
    grams = roll.run(starts, stop[is_start])
    bounds = np.searchsorted(starts, w.off)
    return [np.unique(grams[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]


def _samples(sets: list[np.ndarray], k: int) -> np.ndarray:
    """k MinHash samples of each set."""
    rng = np.random.default_rng(11)
    a = rng.integers(0, 1 << 63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 63, k, dtype=np.uint64)
    out = np.full((len(sets), k), np.iinfo(np.uint64).max, np.uint64)
    for i, s in enumerate(sets):
        for at in range(0, len(s), 2048):
            np.minimum(out[i], (s[at:at + 2048, None] * a + b).min(axis=0), out=out[i])
    return out


SIGNATURE = "doc_id long, n_shingles long, set_a long, set_b long, keys array<long>, sketch binary"


def signatures(docs: DataFrame, plan: Plan) -> DataFrame:
    k = plan.bands * ROWS

    def one(piece: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(piece.column("text"), plan.shingle)
        m = _samples(sets, k)
        keys = np.zeros((len(sets), plan.bands), np.uint64)
        for r in range(ROWS):
            keys = mix(keys + m[:, r::ROWS] + np.arange(plan.bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        place = (mix(m ^ mix(np.arange(1, k + 1, dtype=np.uint64))) % np.uint64(BITS)).astype(np.int64)
        flips = np.bincount((place + np.arange(len(sets))[:, None] * BITS).reshape(-1), minlength=len(sets) * BITS)
        sketch = np.packbits((flips & 1).astype(np.uint8).reshape(len(sets), BITS), axis=1)
        offs = pa.array(np.arange(0, keys.size + 1, plan.bands, dtype=np.int32))
        hashes = [np.array([mix(s ^ np.uint64(c)).sum(dtype=np.uint64) for s in sets], np.uint64) for c in (0, 0xA5A5A5A5A5A5A5A5)]
        return pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), *(pa.array(signed(h)) for h in hashes),
             pa.ListArray.from_arrays(offs, pa.array(signed(keys.reshape(-1)))), pa.array([x.tobytes() for x in sketch], pa.binary())],
            ["doc_id", "n_shingles", "set_a", "set_b", "keys", "sketch"])

    return documents(docs).mapInArrow(lambda b: in_pieces(b, one, 2 << 20), SIGNATURE)


# --- candidates in buckets ---------------------------------------------------

def _forest(labels: np.ndarray, i: int, others: np.ndarray) -> list[int]:
    """Link i with others: one of each other tree, whose labels are merged into i's; returns those linked."""
    linked = []
    for j in others.tolist():
        if labels[j] != labels[i]:
            labels[labels == labels[j]] = labels[i]
            linked.append(j)
    return linked


def candidate_links(ids: np.ndarray, sizes: np.ndarray, sketches: np.ndarray, plan: Plan) -> list[tuple[int, int]]:
    """A spanning forest of the pairs whose sketches and sizes allow a link."""
    labels, out = np.arange(len(ids)), []
    small, big = plan.threshold.numerator, plan.threshold.denominator
    for i in range(len(ids) - 1):
        ones = np.bitwise_count(sketches[i + 1:] ^ sketches[i]).sum(axis=1)
        n, own = sizes[i + 1:], sizes[i]
        near = (ones <= plan.most) & (np.minimum(n, own) * big >= small * np.maximum(n, own)) & (labels[i + 1:] != labels[i])
        for j in _forest(labels, i, np.flatnonzero(near) + i + 1):
            out.append((int(ids[i]), int(ids[j])))
    return out


BUCKET = "a long, b long, key long, block int, n long, sketch binary"


def _columns(batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sketches = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint64).reshape(batch.num_rows, -1)
    return batch.column("id").to_numpy(), batch.column("n").to_numpy(), sketches


def _buckets(plan: Plan, limit: int):
    """Over rows sorted by key: links of each bucket, or, of a bucket beyond ``limit``, its members by block."""
    def run(batches):
        key, held, rows, block = None, [], 0, 0
        out: list[tuple] = []

        def spill() -> None:
            nonlocal held, rows, block
            t = pa.Table.from_batches(held).combine_chunks()
            for i, n, s in zip(t["id"].to_pylist(), t["n"].to_pylist(), t["sketch"].to_pylist()):
                out.append((i, None, key, block, n, s))
            held, rows, block = [], 0, block + 1

        def flush() -> None:
            nonlocal held, rows, block
            if block and rows:
                spill()
            elif rows > 1:
                ids, n, s = _columns(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                out.extend((a, b, None, None, None, None) for a, b in candidate_links(ids, n, s, plan))
            held, rows, block = [], 0, 0

        def result() -> pa.RecordBatch:
            cols = list(zip(*out))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["a", "b", "key", "block", "n", "sketch"])
            out.clear()
            return batch

        for b in batches:
            if not b.num_rows:
                continue
            keys = b.column("key").to_numpy()
            bounds = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
            size = np.diff(bounds)
            # runs that may hold or join a pair: longer ones, and those at the batch's ends
            for r in np.flatnonzero((size > 1) | (np.arange(len(size)) % max(1, len(size) - 1) == 0)):
                if key is None or keys[bounds[r]] != key:
                    flush()
                    key = keys[bounds[r]].item()
                for at in range(bounds[r], bounds[r + 1], limit):
                    part = b.slice(at, min(limit, bounds[r + 1] - at))
                    if rows + part.num_rows > limit:
                        spill()
                    held.append(part)
                    rows += part.num_rows
                if len(out) > 20_000:
                    yield result()
        flush()
        if out:
            yield result()

    return run


def _pairs_of_blocks(members: DataFrame, blocks: DataFrame, key: str) -> DataFrame:
    """Each member (with ``block``) once for every other block of its ``key``, as rows of the pair (low, high)."""
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return members.join(blocks, key).select(*members.columns, other).filter("other <> block").select(
        *members.columns, F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))


def _group_runs(batches, names: list[str]):
    """Whole groups of rows that are sorted by ``names``; a group is bounded by whoever formed it."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(n).to_numpy(zero_copy_only=False) for n in names]
        change = np.zeros(b.num_rows - 1, bool)
        for c in cols:
            change |= c[1:] != c[:-1]
        bounds = np.concatenate([[0], np.flatnonzero(change) + 1, [b.num_rows]])
        for x, y in zip(bounds[:-1], bounds[1:]):
            key = tuple(c[x] for c in cols)
            if key != last and held:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(b.slice(x, y - x))
            last = key
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _links(of_group):
    """Rows (a, b) of the links that ``of_group`` finds in each group."""
    def run(batches, names):
        out = []
        for t in _group_runs(batches, names):
            out.extend(of_group(t))
            if len(out) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])

    return run


def candidates(classes: DataFrame, plan: Plan, bucket: int) -> DataFrame:
    """Edges (a, b) between representatives that their bands and sketches make candidates."""
    banded = classes.select("id", F.col("n_shingles").alias("n"), "sketch", F.explode("keys").alias("key"))
    found = cut(banded.repartition("key").sortWithinPartitions("key", "id").mapInArrow(_buckets(plan, bucket), BUCKET))
    members = found.filter("key is not null").select(F.col("a").alias("id"), "key", "block", "n", "sketch")
    blocks = members.groupBy("key").agg((F.max("block") + 1).alias("blocks"))
    pairs = _pairs_of_blocks(members, blocks, "key")
    run = _links(lambda t: candidate_links(*_columns(t.to_batches()[0]), plan))
    names = ["key", "low", "high"]
    more = pairs.repartition(*names).sortWithinPartitions(*names, "id").mapInArrow(lambda b: run(b, names), "a long, b long")
    return found.filter("key is null").select("a", "b").unionAll(more)


# --- exact links in clusters -------------------------------------------------

def exact_links(ids: list[int], sets: list[np.ndarray], threshold: Fraction) -> list[tuple[int, int]]:
    """A spanning forest of the links: intersections are counted through posting lists of shingles."""
    m = len(ids)
    size = np.array([len(s) for s in sets], np.int64)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(m), size)
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    gram = np.empty(len(values), np.int64)
    gram[order] = np.cumsum(first) - 1
    start = np.flatnonzero(first)
    length = np.diff(np.append(start, len(values)))
    owners = owner[order]
    off = np.concatenate([[0], np.cumsum(size)])
    labels, out = np.arange(m), []
    for i in range(m):
        if (labels == labels[0]).all():
            break  # all are one tree: further links tell nothing
        g = gram[off[i]:off[i + 1]]
        g = g[length[g] > 1]
        if not len(g):
            continue
        both = np.bincount(gather(owners, start[g], length[g])[0], minlength=m)
        linked = (threshold.denominator * both >= threshold.numerator * (size + size[i] - both)) & (labels != labels[i])
        for j in _forest(labels, i, np.flatnonzero(linked)):
            if ids[i] != ids[j]:
                out.append((ids[i], ids[j]))
    return out


def confirmed(docs: DataFrame, clusters: DataFrame, plan: Plan, cluster: int, cluster_shingles: int) -> DataFrame:
    """Edges (a, b) of exact links between the documents of each cluster (id, cluster, n)."""
    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("members"), F.sum("n").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("members") / cluster), F.ceil(F.col("shingles") / cluster_shingles)).cast("int")
    placed = clusters.join(sizes.select("cluster", blocks.alias("blocks")), "cluster").select(
        "id", "cluster", "blocks", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"))

    def to_sets(piece: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(piece.column("text"), plan.shingle)
        return pa.RecordBatch.from_arrays([*(piece.column(c) for c in ("id", "cluster", "blocks", "block")),
                                           pa.array([s.tobytes() for s in sets], pa.binary())],
                                          ["id", "cluster", "blocks", "block", "shingles"])

    # always a shuffled join, so that the plan (and what it moves) is the same at every size
    sets = docs.join(placed.hint("merge"), docs["doc_id"] == placed["id"]).select("id", "cluster", "blocks", "block", "text").mapInArrow(
        lambda b: in_pieces(b, to_sets), "id long, cluster long, blocks int, block int, shingles binary")
    other = F.explode(F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = sets.select("id", "cluster", "shingles", "blocks", "block", other.alias("other")).filter(
        "blocks = 1 or other <> block").select("id", "cluster", "shingles", F.least("block", "other").alias("low"),
                                               F.greatest("block", "other").alias("high"))
    names = ["cluster", "low", "high"]

    def of_group(t: pa.Table) -> list[tuple[int, int]]:
        return exact_links(t["id"].to_pylist(), [np.frombuffer(x, np.uint64) for x in t["shingles"].to_pylist()], plan.threshold)

    run = _links(of_group)
    return pairs.repartition(*names).sortWithinPartitions(*names, "id").mapInArrow(lambda b: run(b, names), "a long, b long")


def near_duplicates(docs: DataFrame, threshold: float | Fraction = 0.8, shingle: int = 5, miss: float = 1e-8,
                    bucket: int = 2048, cluster: int = 512, cluster_shingles: int = 4_000_000) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable over links) and kept (its own) of every document."""
    plan = Plan.of(Fraction(threshold).limit_denominator(1000), shingle, miss)
    rows = documents(docs)
    signed_rows = cut(signatures(docs, plan))
    one_set = ["set_a", "set_b"]
    # equal sets have equal keys and sketches, so grouping by all keeps one row a set
    classes = cut(signed_rows.filter("n_shingles > 0").groupBy(*one_set, "n_shingles", "sketch", "keys").agg(
        F.min("doc_id").alias("id")))
    clusters = components(candidates(classes, plan, bucket)).select(F.col("node").alias("id"), F.col("component").alias("cluster"))
    sized = cut(clusters.join(classes.groupBy("id").agg(F.max("n_shingles").alias("n")), "id"))
    links = confirmed(rows, sized, plan, cluster, cluster_shingles)
    found = components(links).select(F.col("node").alias("id"), "component")
    by_set = classes.select("id", *one_set).join(found, "id", "left").select(
        *one_set, F.coalesce("component", "id").alias("component"))
    return signed_rows.select("doc_id", "n_shingles", *one_set).join(by_set, one_set, "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")).withColumn(
        "kept", F.col("doc_id") == F.col("component_id"))


def first_copies(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` (all columns) without those that another one of their group represents.

    Of each group one row stays: one with the smallest id, or with none if no row of the group has an id."""
    rows, key = keyed(docs)
    found = near_duplicates(rows.select(F.col(key).alias("doc_id"), "text"), **settings)
    ids = rows.select(F.col(key).alias("r"), F.col("doc_id").cast("long").alias("i"))
    in_order = F.struct(F.col("i").isNull().alias("last"), "i", "r")
    firsts = (found.filter("n_shingles > 0").join(ids.hint("merge"), F.col("doc_id") == F.col("r")).groupBy("component_id")
              .agg(F.min(in_order)["r"].alias("first")))
    gone = (found.filter("n_shingles > 0").join(firsts, "component_id").filter("doc_id <> first").select("doc_id"))
    return without(rows, key, gone)
