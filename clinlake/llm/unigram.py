"""SentencePiece-style encoding and decoding: unigram Viterbi over a double-array trie.

The pieces and scores come from a ``.model`` file (nothing is trained).  They
are stored in a double-array trie over UTF-8 bytes; the best segmentation of a
text maximises the sum of the pieces' scores, by Viterbi over the trie's
prefix matches at each character.  A character that no piece covers costs the
lowest score less 10 and is written as its byte pieces.  Spaces become the
marker U+2581, with one in front of the text; decoding reverses both.

Texts are cut where a marker follows another character.  No piece of a usual
model goes over such a place (``Model`` checks this; otherwise texts are not
cut), so cutting changes nothing, and each distinct unit of a piece of texts
is segmented once.  Equal sums prefer the longer last piece; scores are summed
exactly in fixed point, so that a sum does not depend on what stands before it.

Cases: a null or empty text has no ids and decodes to an empty text; texts
may hold any character, the marker too (a marker in a text decodes to a space,
as in the public library); rows without an id take no part; repeated rows are
encoded each; an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.llm.common import UnitCache, documents, gather, in_pieces, text_bytes

MARK = "▁"
UNKNOWN_PENALTY = 10.0  # fixed value: below the lowest score, as the public library has it
NORMAL, USER, BYTE = 1, 4, 6  # fixed values: piece types in the file
UNIGRAM = 1  # fixed value: kind of model in the file
FIXED = 1 << 16  # scores are summed exactly, as multiples of 1 / FIXED
UNREACHED = -(1 << 62)


# --- the model file (protocol buffer wire format) ----------------------------

def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, at
        shift += 7


def _fields(data: bytes):
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            n, at = _varint(data, at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at:at + n], at + n
        yield key >> 3, value


def load_pieces(path: str) -> list[tuple[str, float, int]]:
    """(piece, log score, type) of each id of a model file: repeated field 1 of {1: piece, 2: score, 3: type}.

    The scores of a unigram file are log probabilities.  Those of a BPE file are negated merge ranks, which are
    turned into log probabilities by Zipf's law (1 / (rank + 1), normalised); pieces outside the merges (their score is a large
    negative number) rank last."""
    with open(path, "rb") as f:
        data = f.read()
    out, kind = [], UNIGRAM
    for number, value in _fields(data):
        if number == 1:
            x = dict(_fields(value))
            score = float(np.frombuffer(x.get(2, bytes(4)), "<f4")[0])
            out.append((x.get(1, b"").decode(), score, x.get(3, NORMAL)))
        elif number == 2:  # the trainer's settings; 3: kind of model
            kind = dict(_fields(value)).get(3, UNIGRAM)
    if kind == UNIGRAM:
        return out
    last = len(out)
    total = np.log(np.sum(1 / np.arange(1, last + 1)))
    return [(p, float(-np.log(min(-s, last) + 1) - total), t) for p, s, t in out]


# --- double-array trie -------------------------------------------------------

@dataclass
class DoubleArray:
    """State s moves by byte c to t = base[s] + c + 1 where check[t] == s; value[s] is the id ending there, or -1."""

    base: list[int]
    check: list[int]
    value: list[int]

    @classmethod
    def build(cls, keys: dict[bytes, int]) -> DoubleArray:
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for key, value in keys.items():
            node = 0
            for c in key:
                nxt = children[node].get(c)
                if nxt is None:
                    nxt = len(children)
                    children[node][c] = nxt
                    children.append({})
                    ends.append(-1)
                node = nxt
            ends[node] = value
        size = 2 * len(children) + 512
        base, check, final = [0] * size, [-1] * size, [-1] * size
        check[0], final[0] = 0, ends[0]
        used = bytearray(size)
        used[0] = 1
        low, todo = 1, [(0, 0)]
        while todo:
            node, state = todo.pop()
            if not children[node]:
                continue
            codes = [c + 1 for c in sorted(children[node])]
            b = max(1, low - codes[0])
            while True:
                if b + 258 > size:
                    grow = size
                    base += [0] * grow
                    check += [-1] * grow
                    final += [-1] * grow
                    used += bytearray(grow)
                    size += grow
                if not any(used[b + c] for c in codes):
                    break
                at = used.find(0, b + codes[0] + 1)  # the next place that is free for the first code
                b = (at if at >= 0 else size) - codes[0]
            base[state] = b
            for c in codes:
                used[b + c] = 1
                check[b + c] = state
                child = children[node][c - 1]
                final[b + c] = ends[child]
                todo.append((child, b + c))
            while low < size - 1 and used[low]:
                low += 1
        return cls(base, check, final)


class Model:
    """Pieces, scores and the trie.  Its size is the vocabulary's; it travels to the tasks as a broadcast."""

    def __init__(self, pieces: list[tuple[str, float, int]]):
        self.pieces = [p for p, _, _ in pieces]
        self.scores = [round(s * FIXED) for _, s, _ in pieces]
        words = {p.encode(): i for i, (p, _, t) in enumerate(pieces) if t in (NORMAL, USER) and p}
        self.trie = DoubleArray.build(words)
        self.bytes = {int(p[3:5], 16): i for i, (p, _, t) in enumerate(pieces) if t == BYTE}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.control = {i for i, (_, _, t) in enumerate(pieces) if t not in (NORMAL, USER, BYTE)}
        self.unknown = round((min((s for _, s, t in pieces if t == NORMAL), default=0.0) - UNKNOWN_PENALTY) * FIXED)
        self.arrays = tuple(np.array(x, np.int64) for x in (self.trie.base, self.trie.check, self.trie.value)) + (
            np.array(self.scores, np.int64),)
        self.byte_ids = np.array([self.bytes.get(b, 0) for b in range(256)], np.int32)
        self.cuts = not any(MARK in p.lstrip(MARK) for p in self.pieces)

    @classmethod
    def load(cls, path: str) -> Model:
        return cls(load_pieces(path))

    def segment(self, data: bytes) -> list[int]:
        """Ids of the best segmentation of marked text (UTF-8)."""
        n = len(data)
        best, back = [None] * (n + 1), [None] * (n + 1)
        best[0] = 0
        base, check, value, scores, unknown = self.trie.base, self.trie.check, self.trie.value, self.scores, self.unknown
        for at in range(n):
            so_far = best[at]
            if so_far is None:
                continue  # inside a character
            first = data[at]
            width = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
            state, alone = 0, False
            for end in range(at, n):
                nxt = base[state] + data[end] + 1
                if check[nxt] != state:
                    break
                state = nxt
                piece = value[state]
                if piece >= 0:
                    to = end + 1
                    alone = alone or to == at + width
                    score = so_far + scores[piece]
                    if best[to] is None or score > best[to]:
                        best[to], back[to] = score, (at, piece)
            if not alone:
                to = at + width
                score = so_far + unknown
                if best[to] is None or score > best[to]:
                    best[to], back[to] = score, (at, -1)
        out, at = [], n
        while at:
            start, piece = back[at]
            out += [piece] if piece >= 0 else [int(self.byte_ids[b]) for b in reversed(data[start:at])]
            at = start
        return out[::-1]

    def segment_many(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``segment`` of many units of marked text: flat ids, and the n+1 offsets of units in them.

        All units move together from place to place (numpy); long ones go one by one."""
        size = np.array([len(u) for u in units], np.int64)
        short = np.flatnonzero(size <= 64)
        out: list = [None] * len(units)
        for i in np.flatnonzero(size > 64):
            out[i] = self.segment(units[i])
        unit, ids = self._viterbi([units[i] for i in short], size[short])
        counts = np.array([0 if x is None else len(x) for x in out], np.int64)
        counts[short] = np.bincount(unit, minlength=len(short))
        off = np.concatenate([[0], np.cumsum(counts)])
        flat = np.empty(off[-1], np.int32)
        flat[off[short][unit] + np.arange(len(unit)) - np.searchsorted(unit, unit)] = ids
        for i in np.flatnonzero(size > 64):
            flat[off[i]:off[i + 1]] = out[i]
        return flat, off

    def _viterbi(self, units: list[bytes], size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(unit, id) in order of the best segmentations."""
        base, check, value, score = self.arrays
        data = np.frombuffer(b"".join(units), np.uint8)
        begin = np.cumsum(size) - size  # of the unit's bytes; its places are shifted by its number
        place0 = begin + np.arange(len(units))
        best = np.full(len(data) + len(units), UNREACHED)
        piece = np.full(len(best), -1, np.int32)
        came = np.zeros(len(best), np.int8)
        best[place0] = 0
        for at in range(int(size.max(initial=0))):
            live = np.flatnonzero(size > at)
            live = live[best[place0[live] + at] > UNREACHED]  # others are inside a character
            lead = data[begin[live] + at]
            width = np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))
            alone = np.zeros(len(live), bool)
            u, row, state, so_far = live, np.arange(len(live)), np.zeros(len(live), np.int64), best[place0[live] + at]
            end = at
            while len(u):
                nxt = base[state] + data[begin[u] + end] + 1
                ok = check[nxt] == state
                u, row, state, so_far = u[ok], row[ok], nxt[ok], so_far[ok]
                end += 1
                v = value[state]
                hit = np.flatnonzero(v >= 0)
                alone[row[hit]] |= end == at + width[row[hit]]
                self._better(best, piece, came, place0[u[hit]] + end, so_far[hit] + score[v[hit]], v[hit], end - at)
                more = size[u] > end
                u, row, state, so_far = u[more], row[more], state[more], so_far[more]
            lost = ~alone
            to = place0[live[lost]] + at + width[lost]
            self._better(best, piece, came, to, best[place0[live[lost]] + at] + self.unknown, -1, width[lost])
        steps, place, u = [], place0 + size, np.arange(len(units))
        while len(u):
            go = place > place0[u]
            u, place = u[go], place[go]
            steps.append((u, piece[place], place - u, came[place].astype(np.int64)))
            place = place - came[place]
        if not steps:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        unit, ids, stop, width = (np.concatenate(x) for x in zip(*steps))
        # an unknown character is as many byte pieces as it has bytes
        times = np.where(ids < 0, width, 1)
        at = np.repeat(stop - times, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        unit, ids = np.repeat(unit, times), np.repeat(ids, times)
        raw = ids < 0
        ids[raw] = self.byte_ids[data[at[raw]]]
        order = np.argsort(at, kind="stable")  # places ascend over units and within them
        return unit[order], ids[order]

    @staticmethod
    def _better(best, piece, came, to, score, which, width) -> None:
        wins = score > best[to]
        to = to[wins]
        best[to] = score[wins]
        piece[to] = which if np.isscalar(which) else which[wins]
        came[to] = width if np.isscalar(width) else width[wins]

    def decode_bytes(self, ids) -> bytes:
        """Marked text of the ids; control pieces write nothing."""
        return b"".join(bytes([self.byte_of[i]]) if i in self.byte_of else b"" if i in self.control
                        else self.pieces[i].encode() for i in ids)

    def encode(self, text: str) -> list[int]:
        return self.segment((MARK + text.replace(" ", MARK)).encode()) if text else []

    def decode(self, ids) -> str:
        return unmarked(self.decode_bytes(ids))


def unmarked(data: bytes) -> str:
    text = data.decode("utf-8", "replace")
    return (text[1:] if text.startswith(MARK) else text).replace(MARK, " ")


def marked_units(texts: pa.Array, cuts: bool) -> tuple[pa.Array, np.ndarray]:
    """Units of the texts over their raw bytes, cut where a space follows another character (the first space of a
    run), and n+1 offsets of texts in them.  Each text gets the leading marker as a space of its own."""
    data, off = text_bytes(texts)
    n = len(off) - 1
    size = np.diff(off)
    has = size > 0
    # a space before each text that is not empty
    new_off = off + np.concatenate([[0], np.cumsum(has)])
    joined = np.insert(data, off[:-1][has], 32) if len(data) else data
    starts = np.zeros(len(joined), bool)
    begin = new_off[:-1][has]
    if cuts and len(joined):
        space = joined == 32
        # a marker written out in the text also ends a unit's word; such texts are left whole from there on
        starts[1:] = space[1:] & ~space[:-1]
        mark = np.frombuffer(MARK.encode(), np.uint8)
        if len(joined) >= 3:
            at = np.flatnonzero((joined[:-2] == mark[0]) & (joined[1:-1] == mark[1]) & (joined[2:] == mark[2]))
            for i in at:  # a run of spaces that touches a marker is not cut
                starts[i + 3:i + 4] = False
    starts[begin] = True
    at = np.flatnonzero(starts)
    bounds = np.append(at, len(joined)).astype(np.int64)
    arr = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(joined.tobytes())])
    return arr, np.searchsorted(at, new_off) if n else np.zeros(1, np.int64)


class Codec:
    """Encodes and decodes pieces of texts; remembers distinct units across pieces up to a bound."""

    def __init__(self, model: Model):
        mark = MARK.encode()
        self.model = model
        self.cache = UnitCache(lambda new: model.segment_many([u.replace(b" ", mark) for u in new]))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids, and the n+1 offsets of texts in them."""
        unit, off = marked_units(texts, self.model.cuts)
        flat, end = self.cache.ids(unit)
        return flat, end[off]

    def decode(self, flat: np.ndarray, off: np.ndarray) -> list[str]:
        """Texts of the ids, from the bytes of each piece."""
        table = [self.model.decode_bytes([i]) for i in range(len(self.model.pieces))]
        size = np.array([len(x) for x in table], np.int64)
        data = np.frombuffer(b"".join(table), np.uint8)
        joined, end = gather(data, (np.cumsum(size) - size)[flat], size[flat])
        joined, bounds = joined.tobytes(), end[off]
        return [unmarked(joined[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]


def _list(flat: np.ndarray, off: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(flat))


def encode(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, ids (array of int) of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        codec = Codec(shared.value)
        return in_pieces(batches, lambda p: pa.RecordBatch.from_arrays(
            [p.column("doc_id"), _list(*codec.encode(p.column("text")))], ["doc_id", "ids"]))

    return documents(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: Model) -> DataFrame:
    """doc_id, ids and text of each row of ``encode``."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        codec = Codec(shared.value)
        for b in batches:
            for a in range(0, b.num_rows, 1000):
                part = b.slice(a, 1000)
                ids = part.column("ids")
                off = ids.offsets.to_numpy().astype(np.int64)
                texts = codec.decode(ids.flatten().to_numpy(zero_copy_only=False), off - off[0])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids, pa.array(texts, pa.string())],
                                                 ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")


def round_trip(docs: DataFrame, model: Model, every: bool = False) -> DataFrame:
    """doc_id, ids and text, where the ids of each text are decoded again in the same task (``every``: also of rows
    without an id)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        codec = Codec(shared.value)

        def one(p: pa.RecordBatch) -> pa.RecordBatch:
            flat, off = codec.encode(p.column("text"))
            return pa.RecordBatch.from_arrays([p.column("doc_id"), _list(flat, off), pa.array(codec.decode(flat, off), pa.string())],
                                              ["doc_id", "ids", "text"])

        return in_pieces(batches, one)

    return documents(docs, every=every).mapInArrow(run, "doc_id long, ids array<int>, text string")
