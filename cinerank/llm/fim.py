"""Fill-in-the-middle: texts cut at two unit boundaries and written as prefix, suffix, middle (psm) or suffix first (spm).

A unit is a word with the white space before it, or white space that no word follows; the units of a text tile it.  Four
numbers drawn from the sha256 of seed and key choose the two cuts, whether a text is transformed at all, and the form, so
a row's result depends on nothing but its key and text.

Each batch runs through ``pyarrow.compute``: the units as a list array over the texts' own bytes, flattened with the index
of their row, numbered inside it, filtered by role, rebuilt as lists and joined.  ``restore`` gives the text back from
output and form.  A null text counts as empty; empty texts and texts that hold a marker stay plain.  A null key counts as
the empty text.  Rows, repeated ones too, are kept one for one; result names replace columns of the same name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinerank.llm.common import byte_column, pieces, widened, word_spans

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


def draws(key: str = "doc_id", seed: int = 42) -> Column:
    """Four numbers below 2^32 from the hex sha256 of ``seed:key``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    return F.array(*(F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)))


def unit_lists(texts: pa.Array) -> pa.ListArray:
    """The units of each text as a list array; the strings lie in one buffer, nothing is copied twice."""
    buf, off = byte_column(texts)
    _, ends, _ = word_spans(buf, off)
    edge = np.zeros(len(buf) + 1, bool)
    edge[ends] = True
    edge[off[1:][np.diff(off) > 0]] = True
    edge[0] = False
    bounds = np.concatenate([[0], np.flatnonzero(edge)])
    values = pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(buf)))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(bounds, off), pa.int32()), values)


def cut(texts: pa.Array, first: pa.Array, second: pa.Array) -> tuple[pa.Array, list[pa.Array]]:
    """The number of units of each text, and its units before, between and after the two cuts, each joined.

    The cuts are the draws modulo the number of units and one.
    """
    lists = unit_lists(texts)
    n = pc.list_value_length(lists)
    room = pc.add(n, 1)
    rest = lambda x: pc.subtract(x, pc.multiply(pc.divide(x, room), room))
    a, b = rest(first), rest(second)
    low, high = pc.min_element_wise(a, b), pc.max_element_wise(a, b)
    parent, unit = pc.list_parent_indices(lists), pc.list_flatten(lists)
    starts = pc.subtract(pc.cumulative_sum(n), n)
    ordinal = pc.subtract(pa.array(np.arange(len(unit))), pc.take(starts, parent))
    role = pc.add(pc.greater_equal(ordinal, pc.take(low, parent)).cast(pa.int8()), pc.greater_equal(ordinal, pc.take(high, parent)).cast(pa.int8()))
    joined = []
    for k, size in enumerate((low, pc.subtract(high, low), pc.subtract(n, high))):
        offsets = pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(size).cast(pa.int32())])
        joined.append(pc.binary_join(pa.ListArray.from_arrays(offsets, pc.filter(unit, pc.equal(role, k))), ""))
    return n, joined


def arranged(texts: pa.Array, draw: pa.ListArray, rate: int, spm_share: int) -> list[pa.Array]:
    """Units, form, code points of prefix and middle, and output of each text."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    h = [pc.list_element(draw, k) for k in range(4)]
    n, (prefix, middle, suffix) = cut(texts, h[0], h[1])
    percent = lambda x: pc.subtract(x, pc.multiply(pc.divide(x, 100), 100))
    plain = pc.or_(pc.equal(n, 0), pc.greater_equal(percent(h[2]), rate))
    for marker in (PREFIX, SUFFIX, MIDDLE):
        plain = pc.or_(plain, pc.match_substring(texts, marker))
    spm = pc.less(percent(h[3]), spm_share)
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
    glue = pc.binary_join_element_wise
    whole = pc.if_else(spm, glue(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle, ""), glue(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle, ""))
    size = lambda x: pc.if_else(plain, pa.scalar(None, pa.int64()), pc.utf8_length(x).cast(pa.int64()))
    return [n.cast(pa.int64()), form, size(prefix), size(middle), pc.if_else(plain, texts, whole)]


COLUMNS = (("n_units", "long"), ("form", "string"), ("prefix_chars", "long"), ("middle_chars", "long"), ("output", "string"))


def transform(df: DataFrame, text: str = "text", key: str = "doc_id", seed: int = 42, rate: int = 50, spm_share: int = 80) -> DataFrame:
    """``df`` with n_units, form (plain, psm, spm), prefix_chars, middle_chars (null if plain) and output.

    ``rate`` percent of the texts are transformed, of those ``spm_share`` percent with the suffix first.  One pass over
    the rows, no shuffle; a batch is worked on in pieces of bounded size, or one longer text.
    """
    kept = df.drop(*(c for c, _ in COLUMNS if c not in (text, key)))
    names = [c for c, _ in COLUMNS]
    if {text, key} & set(names):
        raise ValueError(f"text and key must not be called like a result: {names}")
    columns, drawn = kept.columns, "draws_"
    while drawn in columns:
        drawn += "_"

    def run(batches):
        for batch in batches:
            for i, j in pieces(byte_column(batch.column(text))[1]):
                part = batch.slice(i, j - i)
                new = arranged(part.column(text), part.column(drawn), rate, spm_share)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), *new], names=[*columns, *names])

    return kept.withColumn(drawn, draws(key, seed)).mapInArrow(run, widened(kept, *COLUMNS))


def restore(output: str = "output", form: str = "form") -> Column:
    """The text that gave this output.

    The markers stand in the output once each, for a text that holds one stays plain and no marker's end is its start.
    """
    part = F.split(F.col(output), f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    at = lambda k: F.get(part, F.lit(k))
    return F.when(F.col(form) == "psm", F.concat(at(1), at(3), at(2))).when(F.col(form) == "spm", F.concat(at(2), at(3), at(1))).otherwise(F.col(output))
