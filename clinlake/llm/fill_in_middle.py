"""Fill-in-the-middle transformation: documents cut at random unit boundaries and rearranged.

A text is cut into units (runs of letters, or single other code points).
Its prefix, middle and suffix are runs of units whose bounds are drawn from a
hash of the document id; the form says in which order they are written:

* ``psm``: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle
* ``spm``: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle
* ``plain``: the text as it is

The draws are columns that the JVM computes.  The cutting is one pipeline of
``pyarrow.compute`` kernels per piece of a batch, with no loop over rows: mark
the end of every unit and split there (list arrays), flatten with the parent
index of every unit, subtract the offset of the parent (ordinals), compare them
with the bounds (roles), filter by role, rebuild the lists, and join each list.
Every row is transformed by itself, so nothing is shuffled.

Cases.  A null text counts as empty.  An empty text, one that contains a
marker, and a row without an id (nothing can be drawn) are plain.  Repeated
rows give repeated results, extra columns are ignored, an empty table gives no
rows.  Texts are cut whole, whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinlake.llm.common import in_pieces

# Markers, units and shares of the forms.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_PERCENT_FROM = 90
SPM_PERCENT_BELOW = 20
#: In bytes: a run of letters, another ASCII character, or all bytes of a longer character.
UNIT = rb"([A-Za-z]+|[\x00-@\[-`{-\x7F]|[\xC0-\xFF][\x80-\xBF]*)"
#: This byte occurs in no UTF-8 text, so it can mark the ends of units.
END = b"\xff"

OUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def draws(doc_id: Column, salt: str = "1:") -> list[Column]:
    """Four unsigned 32-bit draws of a document: the first groups of eight hex digits of a SHA-256."""
    digest = F.sha2(F.concat(F.lit(salt), doc_id.cast("string")), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def _modulo(a: pa.Array, b: pa.Array) -> pa.Array:
    return pc.subtract(a, pc.multiply(pc.divide(a, b), b))


def units(texts: pa.Array) -> pa.ListArray:
    """The units of each text, as lists of bytes."""
    marked = pc.replace_substring_regex(texts.cast(pa.large_binary()), UNIT, rb"\1" + END)
    return pc.split_pattern(marked, END)


def _joined(flat: pa.Array, role: pa.Array, size: pa.Array) -> pa.Array:
    """The units of one role joined again: ``size`` of them belong to each text."""
    offsets = pa.array(np.concatenate([[0], np.cumsum(size.to_numpy(zero_copy_only=False))]), pa.int64())
    return pc.binary_join(pa.LargeListArray.from_arrays(offsets, pc.filter(flat, role)), pa.scalar(b"", pa.large_binary()))


def _piece(piece: pa.RecordBatch) -> pa.RecordBatch:
    text = pc.fill_null(piece.column("text"), "").cast(pa.large_string())
    lists = units(text)
    flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    real = pc.greater(pc.binary_length(flat), 0)  # a list ends with the empty rest after its last mark
    flat, parent = pc.filter(flat, real), pc.filter(parent, real).cast(pa.int64())
    n = pa.array(np.bincount(parent.to_numpy(zero_copy_only=False), minlength=len(text)), pa.int64())
    first = pc.subtract(pc.cumulative_sum(n), n)
    ordinal = pc.subtract(pa.array(np.arange(len(flat))), pc.take(first, parent))

    h1, h2, h3, h4 = (pc.fill_null(piece.column(f"h{i}"), 0) for i in (1, 2, 3, 4))
    places = pc.add(n, 1)
    a, b = _modulo(h1, places), _modulo(h2, places)
    low, high = pc.min_element_wise(a, b), pc.max_element_wise(a, b)
    in_prefix = pc.less(ordinal, pc.take(low, parent))
    in_suffix = pc.greater_equal(ordinal, pc.take(high, parent))
    prefix = _joined(flat, in_prefix, low)
    middle = _joined(flat, pc.invert(pc.or_(in_prefix, in_suffix)), pc.subtract(high, low))
    suffix = _joined(flat, in_suffix, pc.subtract(n, high))

    hundred = pa.scalar(100, pa.int64())
    plain = pc.is_null(piece.column("h1"))
    plain = pc.or_(plain, pc.equal(n, 0))
    plain = pc.or_(plain, pc.match_substring_regex(text, f"{PREFIX}|{SUFFIX}|{MIDDLE}"))
    plain = pc.or_(plain, pc.greater_equal(_modulo(h3, hundred), PLAIN_PERCENT_FROM))
    spm = pc.less(_modulo(h4, hundred), SPM_PERCENT_BELOW)

    def joined(*parts) -> pa.Array:
        return pc.binary_join_element_wise(*[pa.scalar(p, pa.large_binary()) if isinstance(p, bytes) else p for p in parts],
                                           pa.scalar(b"", pa.large_binary()))

    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    output = pc.case_when(pc.make_struct(plain, spm), text.cast(pa.large_binary()),
                          joined(s, suffix, p, prefix, m, middle), joined(p, prefix, s, suffix, m, middle))
    form = pc.case_when(pc.make_struct(plain, spm), pa.scalar("plain"), pa.scalar("spm"), pa.scalar("psm"))
    nothing = pa.scalar(None, pa.int64())

    def chars(part: pa.Array) -> pa.Array:
        return pc.if_else(plain, nothing, pc.utf8_length(part.cast(pa.large_string())))

    return pa.record_batch([piece.column("doc_id"), n, form, chars(prefix), chars(middle), output.cast(pa.large_string()).cast(pa.string())],
                           names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def _transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return in_pieces(batches, _piece, 2 << 20)


def fill_in_middle(docs: DataFrame, salt: str = "1:") -> DataFrame:
    """Every document in its drawn form: doc_id, n, form, prefix_chars, middle_chars, output."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.select("*", *draws(F.col("doc_id"), salt)).mapInArrow(_transform, OUT)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of.  A rearranged text contains no marker, and none can arise
    where two parts meet, so the three markers found are those that were written."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)  # the first part is empty
    return (F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
            .when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output))


def digest(out: DataFrame) -> DataFrame:
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
