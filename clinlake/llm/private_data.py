"""Personal data: fixed expressions as seeds, and bootstrapped contextual extraction.

1. A task finds the seed entities of the fixed kinds (email, ip, card, phone)
   and every other identifier-like run (four digits or more, of any length,
   bounded by white space and by cue and quoting characters, as in
   ``id=12345678`` or JSON), and before each of them the lexical contexts: the
   two words before it, and the cue word right before it with its punctuation
   (``id:``).  In the word that holds the run, the parts between bounding
   characters count as words; a word of more than 40 characters stands as its
   hash.
2. Spark builds the pattern-instance graph, one edge per distinct pair of
   context pattern and identifier, and scores it in rounds: a pattern's
   score is the mean score of its instances, damped for few ones; an
   identifier's is the noisy-or of its patterns' scores; seeds keep 1.
3. A pattern counts in a round if at least ``support`` distinct instances
   score ``instance_score`` or more by then, seeds and learnt identifiers
   alike, so each round reaches patterns one hop further from the seeds.
   Rounds go on until the trusted patterns and the sure identifiers are those
   of the round before.  Patterns that reach ``pattern_score`` are trusted, and an identifier of
   score ``instance_score`` or more is extracted wherever a trusted pattern
   precedes it (kind ``context``).

All counts cover all documents.  Only identifiers and their contexts are
shuffled; edges are aggregated before each exchange, and the joins are plain
equi-joins that adaptive execution splits where a pattern is hot.

Cases: a null text is empty; rows without an id take no part; repeated rows
are scanned each (their spans are reported each, their edges count once); an
empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.llm.common import cut, documents, free_name, in_pieces

KINDS = ("email", "ip", "card", "phone", "context")  # in the order of reports

# The contract's expressions.  A digit run that fails fails from its start, so matches may be sought
# there only, which keeps long runs linear; the local part of an address is the run before its @.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
IP = r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)"
CARD = r"[0-9](?:[\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

BOUND = r"""\s=:"',;|&{}#<>?\[\]"""  # what ends an identifier
# Short groups stay one identifier (1,234,567 or 12:34:56 or 00:1a:2b:3c); other runs are sought at their start only, so
# that all is linear.
CANDIDATE = (rf"(?<![^{BOUND}])(?:(?:[0-9]{{1,3}}(?:[:,'\xa0\u2009\u202f][0-9]{{1,3}})+|[0-9A-Fa-f]{{1,4}}(?:::?[0-9A-Fa-f]{{1,4}}){{2,}})"
             rf"(?![^{BOUND}])|[^{BOUND}0-9]*+[0-9][^{BOUND}]*+)")
EDGE = "\"'`.,;:!?()[]{}<>#$%&*=|"
WORD_EDGE = EDGE + "-"
CUES = ":#=|"
MAX_CONTEXT_WORD = 40  # longer words stand as their hash in a pattern
MAX_KEY = 64  # longer identifiers are known by their hash


def emails(text: str, domain: re.Pattern):
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        m = domain.match(text, at + 1) if start < at else None
        if m:
            last = m.end()
            yield start, last
        at = text.find("@", max(at + 1, last))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def seeds(text: str, compiled) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed kinds, by kind and start."""
    domain, ip, card, phone = compiled
    out = [(0, a, b) for a, b in emails(text, domain)] if "@" in text else []
    for m in ip.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
            out.append((1, m.start(), m.end()))
    for m in card.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in phone.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((3, m.start(), m.end()))
    return out


class Contexts:
    """The lexical patterns before places of one text; a word is cut into parts once, where a place needs them."""

    def __init__(self, text: str):
        self.text = text
        self.words = [m.span() for m in re.finditer(r"\S+", text)]
        self.starts = [a for a, _ in self.words]
        self.cut: dict[int, tuple[list[int], list[int]]] = {}

    def parts(self, i: int) -> tuple[list[int], list[int]]:
        """Starts and ends of the parts of word i between bounding characters, stripped, without empty ones."""
        if i not in self.cut:
            starts, ends = [], []
            for m in re.finditer(f"[^{BOUND}]+", self.text[slice(*self.words[i])]):
                left = len(m[0]) - len(m[0].lstrip(WORD_EDGE))
                if left < len(m[0]):
                    starts.append(self.words[i][0] + m.start() + left)
                    ends.append(self.words[i][0] + m.start() + len(m[0].rstrip(WORD_EDGE)))
            self.cut[i] = starts, ends
        return self.cut[i]

    def name(self, start: int, end: int) -> str:
        w = self.text[start:end].lower()
        if any(c.isdigit() for c in w):
            return "<number>"
        return w if len(w) <= MAX_CONTEXT_WORD else "#" + hashlib.sha256(w.encode()).hexdigest()

    def word(self, i: int) -> str:
        start, end = self.words[i]
        w = self.text[start:end]
        left = w.lstrip(WORD_EDGE)
        return self.name(end - len(left), start + len(w.rstrip(WORD_EDGE))) if left else ""

    def before(self, place: int) -> list[str]:
        text, i = self.text, bisect_right(self.starts, place) - 1  # the word that holds the place
        starts, ends = self.parts(i) if place > self.starts[i] else ([], [])
        n = bisect_left(starts, place)
        own, cue = [], None
        if n:
            end = min(ends[n - 1], place)
            while text[end - 1] in WORD_EDGE:
                end -= 1
            own = [self.name(starts[k], ends[k]) for k in range(max(n - 2, 0), n - 1)] + [self.name(starts[n - 1], end)]
            at = place
            while at > end and text[at - 1] not in CUES:
                at -= 1
            cue = f"cue {own[-1]} {text[at - 1] if at > end else ''}"
        elif i and text[self.words[i - 1][1] - 1] in CUES:
            starts, ends = self.parts(i - 1)
            if starts:
                cue = f"cue {self.name(starts[-1], ends[-1])} {text[self.words[i - 1][1] - 1]}"
        two = [self.word(k) for k in range(max(i - 2 + len(own), 0), i)] + own
        return ([f"words {two[0]} {two[1]}"] if len(two) == 2 else []) + ([cue] if cue else [])


def instance(identifier: str) -> str:
    key = re.sub(r"[^0-9A-Za-z@]", "", identifier).lower()
    return key if len(key) <= MAX_KEY else "#" + hashlib.sha256(key.encode()).hexdigest()


SPANS = "array<struct<kind:string,start:int,end:int>>"
SCAN = (f"doc_id long, text_hash long, spans {SPANS}, "
        "found array<struct<patterns:array<string>,instance:string,seed:boolean,start:int,end:int>>")


def scan(docs: DataFrame) -> DataFrame:
    """Seed spans and all identifiers with their context patterns, one row per document."""
    def run(batches):
        compiled = [re.compile(x) for x in (DOMAIN, IP, CARD, PHONE)]
        candidate = re.compile(CANDIDATE)

        def one(piece: pa.RecordBatch) -> pa.RecordBatch:
            spans, found = [], []
            for text in piece.column("text").to_pylist():
                text = text or ""
                own = seeds(text, compiled)
                spans.append([{"kind": KINDS[k], "start": a, "end": b} for k, a, b in own])
                near = [(a, b, True) for _, a, b in own]
                taken = sorted((a, b) for a, b, _ in near)
                i = 0
                for m in candidate.finditer(text):
                    token = m[0]
                    if sum(c.isdigit() for c in token) < 4:
                        continue
                    a = m.start() + len(token) - len(token.lstrip(EDGE))
                    b = m.end() - (len(token) - len(token.rstrip(EDGE)))
                    while i < len(taken) and taken[i][1] <= a:
                        i += 1
                    if a < b and not any(x < b for x, _ in taken[i:i + 4]):
                        near.append((a, b, False))
                known = Contexts(text) if near else None
                found.append([{"patterns": p, "instance": instance(text[a:b]), "seed": s, "start": a, "end": b}
                              for a, b, s in near if (p := known.before(a))])
            kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            founds = pa.list_(pa.struct([("patterns", pa.list_(pa.string())), ("instance", pa.string()), ("seed", pa.bool_()),
                                         ("start", pa.int32()), ("end", pa.int32())]))
            return pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("text_hash"), pa.array(spans, kinds),
                                               pa.array(found, founds)], ["doc_id", "text_hash", "spans", "found"])

        return in_pieces(batches, one)

    return documents(docs).withColumn("text_hash", F.xxhash64("text")).mapInArrow(run, SCAN)


def pattern_scores(edges: DataFrame, instances: DataFrame, instance_score: float) -> DataFrame:
    """pattern, score and distinct sure instances: the mean score of a pattern's instances, damped by one empty instance."""
    return edges.join(instances, "instance").groupBy("pattern").agg(
        (F.sum("score") / (F.count("*") + 1)).alias("pattern_score"),
        F.sum((F.col("score") >= instance_score).cast("int")).alias("sure"))


def _crossed(scored: DataFrame, name: str, score: str, threshold: float) -> tuple:
    """Which rows reach the threshold: their number and the sum of their hashes (two numbers, whatever the input)."""
    return tuple(scored.filter(F.col(score) >= threshold).agg(F.count(F.lit(1)), F.sum(F.xxhash64(name).cast("decimal(38,0)"))).first())


def bootstrap(edges: DataFrame, support: int, instance_score: float = 1.0, pattern_score: float = 1.0,
              rounds: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Scores of patterns and of identifiers over the graph of distinct (pattern, instance, seed) edges.

    Instances of score ``instance_score`` or more support a pattern; at 1 these are the seeds.  Scores never fall from
    one round to the next.  Rounds end when no pattern and no identifier crosses its threshold any more (or after
    ``rounds``)."""
    instances = cut(edges.groupBy("instance").agg(F.max("seed").alias("seed")).withColumn(
        "score", F.col("seed").cast("double")))
    patterns, state, done = None, None, 0
    while done != rounds:
        patterns = cut(pattern_scores(edges.drop("seed"), instances, instance_score).filter(F.col("sure") >= support))
        # noisy-or: 1 - prod(1 - score), with scores kept below 1
        log = F.log1p(-F.least(F.col("pattern_score"), F.lit(1 - 1e-9)))
        learnt = edges.join(patterns, "pattern").groupBy("instance").agg((1 - F.exp(F.sum(log))).alias("learnt"))
        instances = cut(instances.join(learnt, "instance", "left").select(
            "instance", "seed", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("learnt", F.lit(0.0))).alias("score")))
        done += 1
        last, state = state, (_crossed(patterns, "pattern", "pattern_score", pattern_score), _crossed(instances, "instance", "score", instance_score))
        if rounds is None and state == last:
            break
    return patterns, instances


def private_spans(docs: DataFrame, support: int = 3, pattern_score: float = 0.7, instance_score: float = 0.7) -> DataFrame:
    """doc_id, text_hash and spans of every document, by kind and start."""
    scanned = cut(scan(docs).withColumn("row", F.monotonically_increasing_id()))
    found = scanned.select("row", F.explode("found").alias("f")).select("row", "f.*")
    edges = cut(found.select(F.explode("patterns").alias("pattern"), "instance", "seed").groupBy(
        "pattern", "instance").agg(F.max("seed").alias("seed")))
    patterns, instances = bootstrap(edges, support, instance_score, pattern_score)
    trusted = patterns.filter(F.col("pattern_score") >= pattern_score).select("pattern")
    known = instances.filter(F.col("score") >= instance_score).select("instance")
    new = found.filter(~F.col("seed")).select("row", F.explode("patterns").alias("pattern"), "instance", "start", "end").join(
        trusted, "pattern").join(known, "instance").groupBy("row", "start", "end").agg(F.lit(1)).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct(F.lit("context").alias("kind"), "start", "end"))).alias("more"))
    return scanned.join(new, "row", "left").select(
        "doc_id", "text_hash", F.concat("spans", F.coalesce("more", F.array().cast(SPANS))).alias("spans"))


def joined(spans):
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                     s["end"].cast("string"))))


def digest(found: DataFrame) -> DataFrame:
    """The contract columns of ``private_spans``."""
    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = joined(F.filter("spans", lambda s: s["kind"] != "context"))
    return found.select("doc_id", *map(count, KINDS[:4]), F.sha2(base, 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span (overlapping ones as one) replaced by its kind in brackets."""
    out, last, reach = [], 0, -1
    for start, end, kind in sorted(spans):
        if start >= reach:
            out += [text[last:start] if reach < 0 else text[reach:start], f"[{kind.upper()}]"]
        reach = max(reach, end)
    return "".join(out) + text[max(reach, 0):]


def redact(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` (all columns) with personal data masked in ``text``; ``n_chars``, where present, follows the new text.

    Spans of the fixed kinds are found again by the masking task; only texts with further (context) spans are
    looked up, by their hash.  Rows without an id are masked like others."""
    def is_new(s):
        return s["kind"] == KINDS[-1]

    # spans depend on the text and on what is learnt from all documents, so equal texts have equal ones
    text, found, of = F.col("text").cast("string"), free_name(docs, "_more"), free_name(docs, "_hash")
    one = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")
    known = docs.select(one.alias("doc_id"), text.alias("text"))
    more = cut(private_spans(known, **settings).filter(F.exists("spans", is_new)).groupBy("doc_id", "text_hash").agg(
        F.first(F.filter("spans", is_new)).alias(found)).select(F.struct("doc_id", "text_hash").alias(of), found))
    if more.isEmpty():
        rows = docs.withColumn(found, F.lit(None).cast(SPANS))
    else:
        rows = docs.join(more, (one == F.col(of)["doc_id"]) & (F.xxhash64(text) == F.col(of)["text_hash"]), "left").drop(of)
    names = docs.columns

    def run(batches):
        compiled = [re.compile(x) for x in (DOMAIN, IP, CARD, PHONE)]

        def one(piece: pa.RecordBatch) -> pa.RecordBatch:
            texts = []
            for text, more_spans in zip(piece.column("text").to_pylist(), piece.column(found).to_pylist()):
                spans = [(a, b, KINDS[k]) for k, a, b in seeds(text, compiled)] if text else []
                spans += [(s["start"], s["end"], s["kind"]) for s in more_spans or ()]
                texts.append(masked(text, spans) if spans else text)
            cols = {n: piece.column(n) for n in names}
            cols["text"] = pa.array(texts, pa.string())
            if "n_chars" in cols:
                cols["n_chars"] = pa.array([None if t is None else len(t) for t in texts], cols["n_chars"].type)
            return pa.RecordBatch.from_arrays(list(cols.values()), names)

        return in_pieces(batches, one)

    return rows.mapInArrow(run, docs.schema)
