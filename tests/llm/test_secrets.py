"""Secret scans against the contract's expressions run over every text, and the trigram queries."""
import hashlib
import random
import re

import pytest

from clinlake.llm import secrets as S

ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def texts():
    r = random.Random(5)
    parts = ["token = ", "TOKEN:", "PassWord='", "api_key\":", "apikey=", "secret :  ", "passwd", "AKIA", "é", " ", "\n", "ſecret=",
             "toKen=", "abcdef0123456789", "0123456789abcdef0", "ABCDEFGH12345678", "x" * 13, "a.b-c_d/e+f=gh", "-", "=", "\"",
             "ghp_" + "a1" * 20, "sk_live_" + "Z9" * 10, "-----BEGIN RSA PRIVATE KEY-----", "token=token=abcdefghijkl"]
    out = ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(300)]
    return out + [None, "", "AKIA" + "A" * 13, "AKIA" + "A" * 14, "token=" + "a" * 11, "f" * 15, "f" * 16, "é" * 50_000 + "secret=" + "b" * 12]


def test_base_spans_equal_the_contract(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([(*x, "x") for x in rows], "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in S.digest(S.secrets(df)).collect()}
    kinds = ["assign", "access", "hex"]
    for i, t in rows:
        want = base_spans(t)
        listed = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in want)
        assert got[i].base_sha256 == hashlib.sha256(listed.encode()).hexdigest(), (t, listed, got[i].spans)
        assert [got[i][f"n_{k}"] for k in kinds] == [sum(x[1] == n for x in want) for n in range(3)]
        assert set(filter(None, listed.split(","))) <= set(got[i].spans.split(","))


def test_more_rules_add_spans(spark):
    key = "ghp_" + "a1" * 20
    df = spark.createDataFrame([(1, f"é {key} -----BEGIN PRIVATE KEY-----"), (None, key)], "doc_id long, text string")
    row, = S.digest(S.secrets(df)).collect()
    end = 2 + len(key)
    assert row.spans == f"github:2:{end},hex:6:{end},private_key:{end + 1}:{end + 28}"


def test_empty_table(spark):
    assert S.secrets(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("rule", S.RULES, ids=lambda r: r.kind)
def test_query_holds_for_every_match(rule):
    """A text with a match satisfies the rule's query; candidates are found through posting lists."""
    import pyarrow as pa

    from clinlake.llm.common import text_bytes
    from clinlake.llm.secrets import BlockIndex, trigram_query, trigrams_of

    import numpy as np

    many = [t or "" for t in texts()] + ["xoxb-1234567890-abc", "AIza" + "b" * 35, "Bearer " + "c" * 30, "eyJabcdefgh.eyJabcdefgh.abcdefgh"]
    query = trigram_query(rule.pattern)
    vocabulary = {t: i + 1 for i, t in enumerate(sorted(trigrams_of(query)))}
    lookup = np.zeros(1 << 24, np.uint16)
    for t, i in vocabulary.items():
        lookup[(ord(t[0]) << 16) | (ord(t[1]) << 8) | ord(t[2])] = i
    found = set(BlockIndex(*text_bytes(pa.array(many)), vocabulary, lookup).search(query).tolist())
    matching = {i for i, t in enumerate(many) if rule.compiled().search(t)}
    assert matching and matching <= found
    if query != S.ANY:
        assert len(found) < len(many)


def test_rules_without_trigrams_scan_fully():
    assert S.trigram_query("[0-9a-f]{16,}") == S.ANY
    assert S.trigram_query("ab") == S.ANY
    assert S.trigram_query("(abc|d.*)x") == S.ANY
    assert S.trigram_query("(abc|wxyz)+q?") == ("or", ("abc", ("and", ("wxy", "xyz"))))
