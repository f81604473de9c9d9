"""Token record files: exact round trip, order, checksums and the offset index."""
import zlib

import numpy as np
import pyarrow as pa
import pytest

from clinlake.llm import token_files as T
from clinlake.llm.queries import tokenizer_file

TOKENIZER = tokenizer_file("byte_bpe_50k.json")
ODD = [None, "", " ", "  ", "a  b   c\n\n  d  ", "don't 's \t z", "\x1c a \x85 b", "é è  à", "   　 b c   d", "x<|endoftext|> y",
       "日本語 テスト 😀 ok", "w" * 5000, "word " * 3000, "it's 12 345,6 7.8", "\r\n x\r\n  y"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(TOKENIZER)
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 0]


def test_units_give_the_ids_of_whole_texts(library):
    e = T.Encoder(open(TOKENIZER, encoding='utf-8').read())
    for texts in (ODD, ODD[::-1]):  # the second time from memory
        flat, off = e.ids(pa.array(texts, pa.string()))
        for i, t in enumerate(texts):
            assert [*flat[off[i]:off[i + 1]].tolist(), 0] == library(t), t


def test_write_and_read(spark, library, tmp_path):
    docs = [(3 * i, t, "x") for i, t in enumerate(ODD * 4)] + [(6, "again", "y"), (6, "again", "y"), (None, "no id", "z")]
    df = spark.createDataFrame(docs, "doc_id long, text string, start string").repartition(5)
    manifest = T.write(df, TOKENIZER, folder=f"file://{tmp_path}/t", partitions=4, shard_bytes=3000)
    shards = manifest.collect()
    assert len(shards) > 4 and sum(s.records for s in shards) == len(docs) - 1
    want, at = [], 0
    rows = sorted((d for d in docs if d[0] is not None), key=lambda d: d[0])
    got = sorted(T.read(manifest, with_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [d[0] for d in rows]
    by_id = {}
    for d in rows:
        by_id.setdefault(d[0], []).append(library(d[1]))
    for r in got:
        assert r.start == at and list(r.ids) in by_id[r.doc_id]
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.n_tokens == len(r.ids)
        by_id[r.doc_id].remove(list(r.ids))
        at += r.n_tokens
    shuffled = T.read(manifest, seed=1).collect()
    plain = [tuple(r)[:4] for r in got]
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in shuffled) == sorted(plain)


def test_damage_is_found(spark, tmp_path):
    record = T.frame(7, np.array([1, 2, 70_000], np.uint32))
    doc, ids = T.unframe(record)
    assert doc == 7 and ids.tolist() == [1, 2, 70_000]
    for i in range(len(record)):
        with pytest.raises(ValueError):
            T.unframe(record[:i] + bytes([record[i] ^ 1]) + record[i + 1:])
    df = spark.createDataFrame([(1, "a b c"), (2, "d e f")], "doc_id long, text string")
    manifest = T.write(df, TOKENIZER, folder=f"{tmp_path}/t", partitions=1)
    path = manifest.first().path
    local = path.removeprefix("file://")
    data = bytearray(open(local, "rb").read())
    data[30] ^= 1
    open(local, "wb").write(data)
    with pytest.raises(Exception, match="damaged"):
        T.read(manifest).collect()


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert T.read(T.write(df, TOKENIZER)).collect() == []


def test_cuts_between_letters_and_punctuation(library):
    import itertools
    import random

    e = T.Encoder(open(TOKENIZER, encoding="utf-8").read())
    parts = ["a", "Zq", "'", "'s", "'re", "!", "...", "<|endoftext|>", "<|", "|>", "endoftext", " ", "  ", "\n", "é", "5", "-", "_", "%%%", "日"]
    texts = ["".join(x) for x in itertools.product(parts, repeat=3)]
    rng = random.Random(0)
    texts += ["".join(rng.choices(parts, k=40)) for _ in range(300)]
    flat, off = e.ids(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert [*flat[off[i]:off[i + 1]].tolist(), 0] == library(t), t
