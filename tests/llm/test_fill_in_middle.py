"""Fill-in-the-middle forms against a plain reading of the contract and against SQL."""
import hashlib
import re

import pyarrow as pa
import pytest

from clinlake.llm import fill_in_middle as M
from clinlake.llm import sql
from oracle import duck, rows

TEXTS = ["Once upon a time, there was\n a fox.", "", None, "a", "é", "ß-é 日本語 mixed 7 words\r\n\t<S", "<", "with <P> inside", "<M>", "ends with <",
         "<S", "M> starts", "  ", "😀😀 a😀b", "one\x00two", "x" * 5000, "ab1 " * 20000, "\\1 \\0 $1", "Ω≈ç√∫", "á‍"]
DOCS = [(i, t) for i, t in enumerate(TEXTS * 12)] + [(3, "again"), (3, "again"), (-7, "negative id here"), (None, "no id"), (1 << 62, "far away, so far")]


def brute(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    n = len(units)
    if doc_id is None:
        return doc_id, n, "plain", None, None, text
    h = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def frame(spark, data):
    return spark.createDataFrame([(*x, "clash", 1) for x in data], "doc_id long, text string, form string, h1 int").repartition(3)


def test_equals_brute_force(spark):
    want = [brute(*x) for x in DOCS]
    got = M.fill_in_middle(frame(spark, DOCS)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert {"plain", "psm", "spm"} == {r.form for r in got}


def test_digest_equals_sql_and_restores(spark):
    data = [x for x in DOCS if "\x00" not in (x[1] or "")]
    t = pa.table({"doc_id": pa.array([x[0] for x in data], pa.int64()), "text": pa.array([x[1] for x in data], pa.string())})
    got = rows(M.digest(M.fill_in_middle(frame(spark, data))))
    assert got == duck(sql.OP11, documents=t)
    names = ["doc_id", "form", "middle_chars", "n", "output_sha256", "prefix_chars", "restored_sha256"]
    restored = sorted((repr(r[0]), r[names.index("restored_sha256")]) for r in got)
    assert restored == sorted((repr(i), hashlib.sha256((x or "").encode()).hexdigest()) for i, x in data)


def test_empty_table(spark):
    assert M.digest(M.fill_in_middle(frame(spark, DOCS).limit(0))).collect() == []


@pytest.mark.parametrize("text", ["", "ab", "é1", "a é\n"])
def test_units(text):
    got = M.units(pa.array([text], pa.large_string())).to_pylist()[0]
    assert [u.decode() for u in got if u] == re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
