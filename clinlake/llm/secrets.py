"""Secret scans through a trigram inverted index.

From each rule's regular expression a Boolean trigram query is derived (over
ASCII-lower-cased text): literals joined in sequence must all occur (AND),
alternatives give an OR, and what matches anything adds nothing.  A rule
without mandatory trigrams has the query "any text" and scans fully.

A task indexes its documents in blocks of bounded text size.  A block's index
has one posting list (sorted documents) for each trigram that some query
names; the queries intersect and unite posting lists, and only the candidates
are verified with the regular expression.  Blocks are independent, so nothing
is shuffled and memory does not grow with the input.

Spans are code points of the text, end exclusive, leftmost and
non-overlapping per kind.  Cases: a null text is empty; rows without an id
take no part; repeated rows are scanned each; an empty table gives none;
extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from re import _constants as rc
from re import _parser as rp

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.llm.common import ascii_lower_map, documents, in_pieces, text_bytes

ANY = ("and", ())  # the query that every text satisfies
MAX_LITERALS = 16  # exact strings kept while deriving a query


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    keep: Callable[[re.Match], bool] | None = None

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII)


# The base kinds of the contract.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         lambda m: len(m[2]) >= 12),
    Rule("access", r"AKIA[A-Z0-9]+", lambda m: m.end() - m.start() >= 18),
    Rule("hex", r"[0-9a-f]{16,}"),  # runs are maximal, so shorter ones just fail
)

# Further published credential formats.
MORE = (
    Rule("private_key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH |PGP )?PRIVATE KEY(?: BLOCK)?-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"(?:sk|rk)_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("bearer", r"(?i:bearer)\x20+[A-Za-z0-9._~+/-]{20,}=*"),
)

RULES = BASE + MORE


# --- trigram queries ---------------------------------------------------------
# A query is a trigram (str), ("and", parts) or ("or", parts).

def _and(parts) -> tuple | str:
    flat = []
    for p in parts:
        flat += p[1] if isinstance(p, tuple) and p[0] == "and" else [p]
    flat = list(dict.fromkeys(flat))
    return flat[0] if len(flat) == 1 else ("and", tuple(flat))


def _or(parts) -> tuple | str:
    parts = list(dict.fromkeys(parts))
    if any(p == ANY for p in parts):
        return ANY
    return parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _of_literals(literals: set[str]) -> tuple | str:
    """The query of texts that contain one of the literals."""
    return _or([_and([s[i:i + 3] for i in range(len(s) - 2)]) for s in sorted(literals)]) if literals else ANY


def _walk(seq) -> tuple[set[str] | None, tuple | str]:
    """The exact strings a parsed expression can match (None: too many), and its query otherwise."""
    exact: set[str] | None = {""}
    queries = []

    def close() -> None:
        nonlocal exact
        if exact is not None:
            queries.append(_of_literals(exact))
        exact = {""}

    for op, arg in seq:
        strings, query = _item(op, arg)
        if strings is None:
            close()
            queries.append(query)
        else:
            both = {a + b for a in exact for b in strings}
            if len(both) > MAX_LITERALS:
                close()
                both = strings
            exact = both
    if not queries:
        return exact, ANY
    close()
    return None, _and(queries)


def _item(op, arg) -> tuple[set[str] | None, tuple | str]:
    if op is rc.LITERAL:
        return ({chr(arg).lower()} if arg < 128 else None), ANY
    if op is rc.IN and all(o is rc.LITERAL and a < 128 for o, a in arg) and len(arg) <= 8:
        return {chr(a).lower() for _, a in arg}, ANY
    if op is rc.SUBPATTERN:
        return _walk(arg[3])
    if op is rc.BRANCH:
        parts = [_walk(x) for x in arg[1]]
        if all(s is not None for s, _ in parts) and sum(len(s) for s, _ in parts) <= MAX_LITERALS:
            return set().union(*(s for s, _ in parts)), ANY
        return None, _or([_of_literals(s) if s is not None else q for s, q in parts])
    if op in (rc.MAX_REPEAT, rc.MIN_REPEAT):
        low, high, sub = arg
        strings, query = _walk(sub)
        if (low, high) == (0, 1) and strings is not None:
            return strings | {""}, ANY
        if low == high == 1:
            return strings, query
        if low >= 1:
            return None, _of_literals(strings) if strings is not None else query
    return None, ANY


def trigram_query(pattern: str) -> tuple | str:
    """The Boolean trigram query that every text with a match satisfies."""
    strings, query = _walk(rp.parse(pattern, re.ASCII))
    return _of_literals(strings) if strings is not None else query


def trigrams_of(query) -> set[str]:
    return {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1]), set())


class BlockIndex:
    """Posting lists of one block of documents for the trigrams in ``vocabulary``."""

    def __init__(self, data: np.ndarray, off: np.ndarray, vocabulary: dict[str, int], lookup: np.ndarray):
        self.n = len(off) - 1
        low = ascii_lower_map()[data].astype(np.uint32)
        code = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:] if len(low) > 2 else np.zeros(0, np.uint32)
        term = lookup[code]
        at = np.flatnonzero(term)
        doc = np.searchsorted(off, at, side="right") - 1
        inside = at + 3 <= off[doc + 1]
        pairs = np.unique(term[at[inside]].astype(np.int64) * self.n + doc[inside])
        bounds = np.searchsorted(pairs, np.arange(1, len(vocabulary) + 2) * self.n)
        self.postings = {t: pairs[bounds[i - 1]:bounds[i]] - i * self.n for t, i in vocabulary.items()}

    def search(self, query) -> np.ndarray:
        """Documents that satisfy a query, by intersecting and uniting posting lists."""
        if isinstance(query, str):
            return self.postings[query]
        lists = sorted((self.search(q) for q in query[1]), key=len)
        if query[0] == "or":
            return np.unique(np.concatenate(lists))
        found = np.arange(self.n) if not lists else lists[0]
        for x in lists[1:]:
            found = np.intersect1d(found, x, assume_unique=True)
        return found


def _scan(rules: tuple[Rule, ...]):
    queries = [trigram_query(r.pattern) for r in rules]
    vocabulary = {t: i + 1 for i, t in enumerate(sorted(set().union(*map(trigrams_of, queries))))}

    def run(batches):
        lookup = np.zeros(1 << 24, np.uint8 if len(vocabulary) < 256 else np.uint16)
        for t, i in vocabulary.items():
            lookup[(ord(t[0]) << 16) | (ord(t[1]) << 8) | ord(t[2])] = i
        compiled = [r.compiled() for r in rules]

        def one(piece: pa.RecordBatch) -> pa.RecordBatch:
            index = BlockIndex(*text_bytes(piece.column("text")), vocabulary, lookup)
            texts = piece.column("text")
            spans: list[list] = [[] for _ in range(piece.num_rows)]
            whole: dict[int, str] = {}
            for k, rule in enumerate(rules):
                for doc in index.search(queries[k]).tolist():
                    if doc not in whole:
                        whole[doc] = texts[doc].as_py() or ""
                    for m in compiled[k].finditer(whole[doc]):
                        if rule.keep is None or rule.keep(m):
                            spans[doc].append((m.start(), k, m.end()))
            out = [[{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in sorted(x)] for x in spans]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            return pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(out, kind)], ["doc_id", "spans"])

        return in_pieces(batches, one)

    return run


def secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and spans (kind, start, end), by start and then by the rules' order."""
    return documents(docs).mapInArrow(_scan(rules), "doc_id long, spans array<struct<kind:string,start:int,end:int>>")


def joined(spans):
    """kind:start:end of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                     s["end"].cast("string"))))


def digest(found: DataFrame) -> DataFrame:
    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = [r.kind for r in BASE]
    return found.select("doc_id", *map(count, base),
                        F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
