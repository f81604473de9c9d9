"""Token ids as length-delimited binary record files with separate offset indexes.

Record (little-endian)::

    u64 length | u32 masked crc32(length) | payload | u32 masked crc32(payload)
    payload = i64 doc_id | u32 n_ids | u8 id width in bytes (2 or 4) | ids

Index file of a shard: one 24-byte entry per record (i64 doc_id, u64 offset of
the record, u32 n_ids, u32 masked crc32 of these three).  A crc is masked by a
rotation and a constant, so that crcs of data that hold crcs stay useful.

Writing.  Texts are ranged by document id, so shards follow each other in
ascending order; a task sorts, encodes and writes its shards of about
``shard_bytes`` each, under a name of its own attempt.  The manifest (one row
per shard) lists the files of the attempts that Spark committed, so a retried
or speculative task leaves at most an unlisted file.

Reading.  Shards are read one at a time, record by record through the index,
in any order (a shuffled read permutes the index entries); lengths and
checksums are verified, and a mismatch fails the task.

Encoding.  The byte-level pre-tokenizer always ends a token before a space
that a non-space follows, and between an ASCII letter and ASCII punctuation
(but for a letter after a quote), so texts are cut there, and each distinct unit is
encoded once by the tokenizers library in each Python worker process, whose
tasks share an encoder (up to a bound of remembered units); the ids of a text
are those of its units in order, equal to encoding the text whole.  The
tokenizer's definition is read by the driver and broadcast.

Cases: a null text is an empty one (only the end id); rows without an id take
no part; repeated rows are records of their own, in (id, text) order; an empty
table writes no shard and reads no row; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import string
import struct
import uuid
import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clinlake.llm.common import UnitCache, cut, documents, per_worker, pieces, shared_dir, text_bytes

HEAD, FOOT, META, ENTRY = "<QI", "<I", "<qIB", "<qQII"  # layouts of the parts of records and of an index entry
HEAD_SIZE, FOOT_SIZE, META_SIZE, ENTRY_SIZE = map(struct.calcsize, (HEAD, FOOT, META, ENTRY))
MASK = 0xA282EAD8  # fixed value: the usual constant of masked checksums
MANIFEST = "path string, index string, part long, shard long, first_id long, last_id long, records long, tokens long, bytes long"


def masked(crc: int) -> int:
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


def checksum(data: bytes) -> int:
    return masked(zlib.crc32(data))


def frame(doc_id: int, ids: np.ndarray) -> bytes:
    """One record."""
    width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    payload = struct.pack(META, doc_id, len(ids), width) + ids.astype(f"<u{width}").tobytes()
    length = struct.pack("<Q", len(payload))
    return length + struct.pack(FOOT, checksum(length)) + payload + struct.pack(FOOT, checksum(payload))


def unframe(record: bytes) -> tuple[int, np.ndarray]:
    """Document id and ids of one record; raises ValueError where lengths or checksums differ."""
    length, crc = struct.unpack_from(HEAD, record)
    if checksum(record[:8]) != crc or len(record) != HEAD_SIZE + length + FOOT_SIZE:
        raise ValueError("record length is damaged")
    payload = record[HEAD_SIZE:HEAD_SIZE + length]
    if struct.unpack_from(FOOT, record, HEAD_SIZE + length)[0] != checksum(payload):
        raise ValueError("record payload is damaged")
    doc_id, n, width = struct.unpack_from(META, payload)
    return doc_id, np.frombuffer(payload, f"<u{width}", n, META_SIZE).astype(np.uint32)


def entry(doc_id: int, offset: int, n_ids: int) -> bytes:
    head = struct.pack("<qQI", doc_id, offset, n_ids)
    return head + struct.pack(FOOT, checksum(head))


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as a URI; without a scheme it lies in the cluster's default file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = found.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(found).toString()
    return f"file://{uri[5:]}" if uri.startswith("file:/") and not uri.startswith("file://") else uri


def _storage(path: str):
    """File system and path of a URI that all executors share."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


# --- encoding ----------------------------------------------------------------

def _safe() -> np.ndarray:
    """Bytes that surely begin a non-space: printable ASCII, or the first byte of a character in whose range
    no white space lies."""
    safe = np.zeros(256, bool)
    safe[0x21:0x7F] = True
    safe[0xC3:0xF5] = True
    safe[[0xE1, 0xE2, 0xE3]] = False
    return safe


def _class(chars: bytes) -> np.ndarray:
    is_in = np.zeros(256, bool)
    is_in[list(chars)] = True
    return is_in


LETTER = _class(string.ascii_letters.encode())
PUNCTUATION = _class(string.punctuation.encode())
NOT_QUOTE = PUNCTUATION & ~_class(b"'")  # a letter after a quote can belong to it ("'s")


def units(texts: pa.Array, whole: Sequence[bytes] = ()) -> tuple[pa.Array, np.ndarray]:
    """The texts cut where a token surely ends, but not inside the strings ``whole``; n+1 offsets of texts in units.

    That is before a space that a surely non-space character follows, and between an ASCII letter and ASCII
    punctuation."""
    data, off = text_bytes(texts)
    begins = np.zeros(len(data) + 1, bool)
    if len(data):
        begins[:-2] = (data[:-1] == 32) & _safe()[data[1:]]
        begins[1:-1] |= (LETTER[data[:-1]] & PUNCTUATION[data[1:]]) | (NOT_QUOTE[data[:-1]] & LETTER[data[1:]])
        raw = data.tobytes()
        for w in whole:
            at = raw.find(w)
            while at >= 0:
                begins[at + 1:at + len(w)] = False
                at = raw.find(w, at + len(w))
    begins[off[:-1][np.diff(off) > 0]] = True
    starts = np.flatnonzero(begins[:-1])
    bounds = np.append(starts, len(data)).astype(np.int64)
    arr = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds.tobytes()),
                                                                pa.py_buffer(data.tobytes())])
    return arr, np.searchsorted(starts, off)


class Encoder:
    """Encodes pieces of texts with a tokenizer file, each distinct unit once.

    New units that begin with a space before a non-space are encoded joined, since a token ends before each of
    them; the byte lengths of the tokens tell where a unit's ids end.  Other units are encoded alone."""

    JOIN = 2000
    REMEMBERED = 600_000

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes_of = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():  # one character of a byte-level token stands for one byte
            self.bytes_of[i] = len(token)
        self.safe = _safe()
        self.whole = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache = UnitCache(self._encode, self.REMEMBERED)

    def _encode(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        joins = np.array([len(u) > 1 and u[0] == 32 and self.safe[u[1]] for u in new])
        # a string of its own for each unit that cannot follow another, else up to JOIN units in one
        head = ~joins
        head[:1] = True
        run = np.arange(len(new)) - np.maximum.accumulate(np.where(head, np.arange(len(new)), 0))
        first = np.flatnonzero(head | (run % self.JOIN == 0))
        last = np.append(first[1:], len(new))
        texts = [b"".join(new[a:b]).decode() for a, b in zip(first, last)]
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.concatenate([np.array(x, np.int32) for x in ids])
        token_end = np.cumsum(self.bytes_of[flat])
        unit_end = np.cumsum([len(u) for u in new])
        off = np.concatenate([[0], np.searchsorted(token_end, unit_end) + 1])
        if not np.array_equal(token_end[off[1:] - 1], unit_end):
            raise ValueError("a token goes over the end of a unit")
        return flat, off

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts, and the n+1 offsets of texts in them."""
        unit, off = units(texts, self.whole)
        flat, end = self.cache.ids(unit)
        return flat, end[off]


# --- writing -----------------------------------------------------------------

def _write(folder: str, definition: Broadcast, digest: str, end_id: int, shard_bytes: int):
    def run(batches):
        from pyspark import TaskContext

        encoder = per_worker(f"encoder:{digest}", lambda: Encoder(definition.value))
        store, base = _storage(folder)
        task = TaskContext.get()
        name = f"{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        shard, data, index, row = 0, None, None, None

        def close():
            data.close()
            index.close()
            return pa.RecordBatch.from_pylist([row], schema=pa.schema(
                [(c, pa.string() if c in ("path", "index") else pa.int64()) for c in row]))

        for piece in pieces(batches):
            flat, off = encoder.ids(piece.column("text"))
            for i, doc in enumerate(piece.column("doc_id").to_pylist()):
                if data is not None and row["bytes"] >= shard_bytes:
                    yield close()
                    data = None
                if data is None:
                    paths = [f"{base}/{name}-{shard:04d}.{x}" for x in ("rec", "idx")]
                    data, index = (store.open_output_stream(p) for p in paths)
                    row = {"path": f"{folder}/{name}-{shard:04d}.rec", "index": f"{folder}/{name}-{shard:04d}.idx",
                           "part": task.partitionId(), "shard": shard, "first_id": doc, "last_id": doc, "records": 0, "tokens": 0, "bytes": 0}
                    shard += 1
                ids = np.append(flat[off[i]:off[i + 1]], end_id)
                record = frame(doc, ids)
                index.write(entry(doc, row["bytes"], len(ids)))
                data.write(record)
                row["last_id"], row["records"] = doc, row["records"] + 1
                row["tokens"], row["bytes"] = row["tokens"] + len(ids), row["bytes"] + len(record)
        if data is not None:
            yield close()

    return run


def write(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 0, partitions: int | None = None,
          shard_bytes: int = 64 << 20) -> DataFrame:
    """Encode and write all documents in ascending id order; returns the manifest, one row per shard.

    Shards in the order (part, shard) hold ascending ids.  The hash of the text is part of the range key, so
    that many rows of one id spread over partitions, and a retried task writes the same records."""
    spark = docs.sparkSession
    folder = qualified(spark, folder or f"{shared_dir(spark)}/tokens")
    with open(tokenizer, encoding="utf-8") as f:
        text = f.read()
    definition = spark.sparkContext.broadcast(text)  # as large as the vocabulary
    store, base = _storage(folder)
    store.create_dir(base, recursive=True)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["doc_id", F.xxhash64("text"), "text"]
    ranged = documents(docs).repartitionByRange(n, *keys[:2]).sortWithinPartitions(*keys)
    return cut(ranged.mapInArrow(_write(folder, definition, hashlib.sha256(text.encode()).hexdigest(), end_id, shard_bytes), MANIFEST))


# --- reading -----------------------------------------------------------------

def _read(with_ids: bool, seed: int | None):
    def run(batches):
        for batch in batches:
            for shard in batch.to_pylist():
                store, path = _storage(shard["path"])
                entries = store.open_input_stream(_storage(shard["index"])[1]).read()
                if len(entries) != ENTRY_SIZE * shard["records"]:
                    raise ValueError(f"index of {path} is damaged")
                order = np.arange(shard["records"])
                if seed is not None:
                    np.random.default_rng([seed, zlib.crc32(path.rpartition("/")[2].encode())]).shuffle(order)
                with store.open_input_file(path) as f:
                    size = f.size()
                    rows: dict[str, list] = {k: [] for k in ("doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids)}
                    # tokens of the records before each one, from the index alone
                    table = np.frombuffer(entries, np.dtype([("doc", "<i8"), ("at", "<u8"), ("n", "<u4"), ("crc", "<u4")]))
                    before = np.concatenate([[0], np.cumsum(table["n"].astype(np.int64))])
                    ends = np.append(table["at"][1:], size).astype(np.int64)
                    held = 0
                    for i in order.tolist():
                        e = entries[i * ENTRY_SIZE:(i + 1) * ENTRY_SIZE]
                        doc, at, n, crc = struct.unpack(ENTRY, e)
                        if checksum(e[:20]) != crc:
                            raise ValueError(f"index of {path} is damaged")
                        f.seek(at)
                        got, ids = unframe(f.read(int(ends[i]) - at))
                        if got != doc or len(ids) != n:
                            raise ValueError(f"index of {path} does not fit its records")
                        rows["doc_id"].append(doc)
                        rows["n_tokens"].append(n)
                        rows["ids_crc32"].append(zlib.crc32(ids.astype("<u4").tobytes()))
                        rows["start"].append(shard["base"] + int(before[i]))
                        if with_ids:
                            rows["ids"].append(ids.astype(np.int32))
                        held += n
                        if held > 1 << 20:
                            yield _batch(rows, with_ids)
                            rows, held = {k: [] for k in rows}, 0
                    yield _batch(rows, with_ids)

    return run


def _batch(rows: dict[str, list], with_ids: bool) -> pa.RecordBatch:
    kinds = {"ids": pa.list_(pa.int32())}
    return pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.int64())) for k, v in rows.items()], list(rows))


def read(manifest: DataFrame, with_ids: bool = False, seed: int | None = None) -> DataFrame:
    """doc_id, start (ids before the document), n_tokens, ids_crc32 (and ids) of every record.

    ``seed`` shuffles the records of each shard through its offset index.  A shard's start is a running
    total over the manifest, which has one small row per ``shard_bytes`` of data."""
    order = Window.orderBy("part", "shard")
    shards = cut(manifest.withColumn("base", F.sum("tokens").over(order) - F.col("tokens")))
    files = shards.select("path", "index", "records", "base").repartition(max(1, shards.count()))
    return files.mapInArrow(_read(with_ids, seed),
                            "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)
