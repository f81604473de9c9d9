"""Personal data: base kinds against the contract's expressions, and what the bootstrap adds."""
import hashlib
import random
import re

import pytest

from clinlake.llm import private_data as P

KINDS = ["email", "ip", "card", "phone"]


def luhn(digits):
    values = [int(c) for c in digits][::-1]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def base(text):
    text = text or ""
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def listed(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def texts():
    r = random.Random(7)
    card = next(str(n) for n in range(4111111111111100, 4111111111111200) if luhn(str(n)))
    parts = ["a.b+c@d-e.com", "@", "x@y", "x@y.z@w.v", "é@b.co", "1.2.3.4", "256.1.1.1", "01.002.3.0255", "1.2.3.4.5.6.7.8", card,
             card[:4] + "-" + card[4:8] + " " + card[8:], "4111111111111112", "+1 (555) 010-9999", "+1-2", "+999999999999999999", "+12345678(",
             " ", "\n", ".", "-", "7", "word", "é", "٣", "+", "x@y.z.", "%@-.-"]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 9))) for _ in range(600)] + [
        None, "", "9" * 5000, "1." * 4000, "a" * 20_000 + "@", "@".join("ab" * 3000), "+1" + " " * 5000]


def test_base_equals_the_contract(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([(*x, "y") for x in rows], "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in P.digest(P.private_spans(df)).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        want = base(t)
        assert got[i].base_sha256 == hashlib.sha256(listed(want).encode()).hexdigest(), (t, got[i].spans)
        assert [got[i][f"n_{k}"] for k in KINDS] == [sum(x[0] == n for x in want) for n in range(4)]
        assert got[i].spans == listed(want) or got[i].spans.startswith(listed(want) + ",context") or got[i].spans.startswith("context")


def contextual():
    docs = [(i, f"Some words here, customer number: user{i}@mail.com and more") for i in range(12)]
    docs += [(20, "Older rows say customer number: AB-4455667 instead"), (21, "the customer number: 99887766."),
             (22, "Version 20240131 of customer things"), (23, "build number 445566 is fine")]
    return docs


def test_contexts_find_unseen_identifiers(spark):
    df = spark.createDataFrame(contextual(), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in P.digest(P.private_spans(df)).collect()}
    text = dict(contextual())
    assert got[20] == f"context:{text[20].index('AB-')}:{text[20].index(' instead')}"
    assert got[21] == f"context:{text[21].index('9988')}:{len(text[21]) - 1}"
    assert got[22] == got[23] == ""


@pytest.mark.parametrize("rounds,sure", [(3, 1.0), (3, 0.7), (None, 0.7), (None, 0.4)])
def test_scores_equal_a_plain_loop(spark, rounds, sure):
    r = random.Random(4)
    edges = list({(f"p{r.randrange(8)}", f"i{r.randrange(40)}") for _ in range(120)})
    is_seed = {i: int(i[1:]) % 3 == 0 for _, i in edges}
    df = spark.createDataFrame([(p, i, is_seed[i]) for p, i in edges], "pattern string, instance string, seed boolean")
    patterns, instances = P.bootstrap(df, support=2, instance_score=sure, pattern_score=0.6, rounds=rounds)
    score, crossed, done = {i: float(s) for i, s in is_seed.items()}, None, 0
    while done != rounds:
        of = {}
        for p, i in edges:
            of.setdefault(p, []).append(i)
        pattern = {p: sum(score[i] for i in x) / (len(x) + 1) for p, x in of.items() if sum(score[i] >= sure for i in x) >= 2}
        for i in score:
            if not is_seed[i]:
                miss = 1.0
                for p, j in edges:
                    if j == i and p in pattern:
                        miss *= 1 - min(pattern[p], 1 - 1e-9)
                score[i] = 1 - miss
        done, last = done + 1, crossed
        crossed = {p for p, s in pattern.items() if s >= 0.6}, {i for i, s in score.items() if s >= sure}
        if rounds is None and crossed == last:
            break
    assert {x.pattern: round(x.pattern_score, 9) for x in patterns.collect()} == {p: round(s, 9) for p, s in pattern.items()}
    assert {x.instance: round(x.score, 9) for x in instances.collect()} == {i: round(s, 9) for i, s in score.items()}


def test_learnt_identifiers_support_further_patterns(spark):
    """seeds -> pattern A -> numbers -> pattern B -> a number that never follows A."""
    docs = [(i, f"the customer number: user{i}@mail.com here") for i in range(30)]
    docs += [(100 + i, f"the customer number: {99887700 + i} here") for i in range(6)]
    docs += [(200 + i, f"our ledger entry {99887700 + i} there") for i in range(6)]
    docs += [(300, "our ledger entry 55443322 there"), (301, "some other entry 55443311 there")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in P.digest(P.private_spans(df)).collect()}
    assert all(got[200 + i] == "context:17:25" for i in range(6))
    assert got[300] == "context:17:25" and got[301] == ""


def test_identifiers_inside_words(spark):
    """key=value, JSON, a long word around or before the identifier."""
    docs = [(i, f"row{'xyz'[i % 3] * (i + 1)} mail=user{i}@mail.com") for i in range(12)]
    docs += [(50 + i, f'{{"a":1,"owner":"user{i}@mail.com"}}') for i in range(12)]
    docs += [(80 + i, f"{'w' * 200} number user{i}@mail.com") for i in range(12)]
    texts = {100: "text mail=99887766 end", 101: "mail=" + "9" * 100, 102: f'{{"z":"{"q" * 900}","owner":55443322,"b":2}}',
             103: f"{'w' * 200} number 66554433", 108: f"{'v' * 200} number 66554433", 104: "x,12121212,y", 105: '{"owner": "55443322"}', 106: "mail=1,234,567",
             107: "f?x=1&mail=31313131&y=2"}
    found = {100: "99887766", 101: "9" * 100, 102: "55443322", 103: "66554433", 105: "55443322", 106: "1,234,567", 107: "31313131"}
    df = spark.createDataFrame(docs + list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in P.digest(P.private_spans(df)).collect()}
    for i, t in texts.items():
        at = t.find(found.get(i, "\0"))
        assert got[i] == (f"context:{at}:{at + len(found[i])}" if i in found else ""), (i, got[i])


def test_contexts_before_places():
    def at(text, x):
        return P.Contexts(text).before(text.index(x))

    assert at("our customer id: 1234", "1234") == ["words customer id", "cue id :"]
    assert at("pay to account=1234", "1234") == ["words to account", "cue account ="]
    assert at('{"x":7,"account":"1234"}', "1234") == ["words <number> account", "cue account :"]
    assert at("a " + "b" * 500 + " 1234", "1234") == ["words a #" + hashlib.sha256(b"b" * 500).hexdigest()]
    assert at("a" * 500 + " b 1234", "1234") == ["words #" + hashlib.sha256(b"a" * 500).hexdigest() + " b"]
    assert at("1234", "1234") == []


def test_long_words_take_linear_time():
    import time

    t, n = time.time(), 0
    for text in ("a" * 500_000, '"id":12345678,' * 40_000, "1.2.3.4/" * 60_000, "-" * 500_000 + "1234", "1,2," * 100_000):
        starts = [m.start() for m in re.finditer(P.CANDIDATE, text)] + [a for _, a, _ in P.seeds(text, [
            re.compile(x) for x in (P.DOMAIN, P.IP, P.CARD, P.PHONE)])]
        known = P.Contexts(text)
        n += sum(len(known.before(a)) for a in starts)
    assert n and time.time() - t < 30


def test_redact(spark):
    docs = [(i, t, "x", len(t)) for i, t in contextual()] + [(30, None, "x", None), (31, "ok", "x", 2), (None, "a@b.cd", "x", 6)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, n_chars long")
    got = P.redact(df)
    assert got.columns == df.columns
    by_id = {r.doc_id: r for r in got.collect()}
    assert by_id[0].text == "Some words here, customer number: [EMAIL] and more" and by_id[0].n_chars == len(by_id[0].text)
    assert by_id[20].text == "Older rows say customer number: [CONTEXT] instead"
    assert by_id[31].text == "ok" and by_id[30].text is None and by_id[None].text == "[EMAIL]"
    assert P.redact(df.filter("doc_id = 31")).collect()[0].text == "ok"


def test_masked_overlaps():
    assert P.masked("abcdefgh", [(1, 3, "a"), (2, 5, "b"), (5, 6, "c")]) == "a[A][C]gh"


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert P.private_spans(df).collect() == [] and P.redact(df).collect() == []
