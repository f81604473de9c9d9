"""Unigram Viterbi against the public library and against all segmentations, and the round trip."""
import itertools
import random

import pyarrow as pa
import pytest

from clinlake.llm import unigram as U
from clinlake.llm.queries import tokenizer_file

MODEL = tokenizer_file("piece_bpe_32k.model")
ODD = ["", " ", "   ", "a ", "  a  b\nc é\t<s> ", "日本語 テスト😀 ", "x \x00 y", "the and with", "w" * 3000, "näive 𝔘 ", "<0x41> </s>"]


@pytest.fixture(scope="module")
def model():
    return U.Model.load(MODEL)


def corpus():
    import pyarrow.parquet as pq

    return [t or "" for t in pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()]


def test_trie_holds_exactly_the_pieces(model):
    trie = model.trie
    want = {p.encode(): i for i, (p, _, t) in enumerate(U.load_pieces(MODEL)) if t in (U.NORMAL, U.USER)}
    for key, i in want.items():
        s = 0
        for c in key:
            n = trie.base[s] + c + 1
            assert trie.check[n] == s
            s = n
        assert trie.value[s] == i
    assert sum(v >= 0 for v in trie.value) == len(want)


def test_equals_the_public_library(model):
    sp = pytest.importorskip("sentencepiece")
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    m = pb.ModelProto()
    m.ParseFromString(open(MODEL, "rb").read())
    m.trainer_spec.model_type = 1
    for p, s in zip(m.pieces, model.scores):
        p.score = s / U.FIXED
    lib = sp.SentencePieceProcessor(model_proto=m.SerializeToString())
    for t in [*ODD, *(x[:80] for x in corpus())]:
        ours, theirs = model.encode(t), lib.encode(t)
        assert abs(sum(model.scores[i] for i in ours) - sum(model.scores[i] for i in theirs)) <= 64, t  # its sums are float32
        assert model.decode(ours) == lib.decode(theirs) == t.replace(U.MARK, " ") or "\x00" in t or t != t.strip()


def test_equals_all_segmentations():
    r = random.Random(2)
    pieces = [("<unk>", 0.0, 2)] + [(f"<0x{b:02X}>", 0.0, U.BYTE) for b in range(256)]
    pieces += [(p, -r.random() * 5, U.NORMAL) for p in ["a", "b", "ab", "ba", "aab", "▁", "▁a", "▁▁", "é", "éa", "bab"]]
    m = U.Model(pieces)
    index = {p: s for (p, _, t), s in zip(pieces, m.scores) if t == U.NORMAL}

    def best(text):
        top = None
        for cuts in itertools.product([0, 1], repeat=len(text) - 1):
            parts, last = [], 0
            for i, c in enumerate(cuts, 1):
                if c:
                    parts.append(text[last:i])
                    last = i
            parts.append(text[last:])
            if all(p in index or len(p) == 1 for p in parts):
                score = sum(index.get(p, m.unknown) for p in parts)
                top = score if top is None else max(top, score)
        return top

    for _ in range(150):
        text = "".join(r.choice("aab é z") for _ in range(r.randint(1, 9)))
        marked = U.MARK + text.replace(" ", U.MARK)
        ids = m.encode(text)
        unknown = sum(1 for c in marked if c not in index)
        score = sum(m.scores[i] for i in ids if i not in m.byte_of) + unknown * m.unknown
        assert score == best(marked), text
        assert m.decode(ids) == text


def test_units_and_batches_equal_whole_texts(model):
    codec = U.Codec(model)
    texts = [*ODD, "▁ x ▁▁ y▁z", "▁", *(t[:300] for t in corpus())]
    for _ in range(2):
        flat, off = codec.encode(pa.array(texts))
        for i, t in enumerate(texts):
            assert flat[off[i]:off[i + 1]].tolist() == model.encode(t), t


def test_round_trip_frames(spark, model):
    texts = [*ODD, None, *corpus()]
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)] + [(0, "twice", 5), (None, "x", 5)],
                               "doc_id long, text string, ids int")
    got = sorted((r.doc_id, r.text) for r in U.round_trip(df, model).collect())
    assert got == sorted([(i, t or "") for i, t in enumerate(texts)] + [(0, "twice")])
    again = sorted((r.doc_id, r.text) for r in U.decode(U.encode(df, model), model).collect())
    assert again == got
    assert U.round_trip(df.limit(0), model).collect() == []


def test_unknown_characters_without_byte_pieces():
    model = U.Model([(U.MARK, -1.0, U.NORMAL), ("a", -1.0, U.NORMAL), (U.MARK + "a", -1.5, U.NORMAL)])
    for text in ("aéa", "é" * 100, "a" * 70 + "é"):
        unit = (U.MARK + text).encode()
        ids, off = model.segment_many([unit])
        assert ids.tolist() == model.segment(unit) and off.tolist() == [0, len(ids)]
        assert (ids == 0).sum() >= 2  # one id 0 for each byte
