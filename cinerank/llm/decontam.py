"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are sequences of tokens (runs of ASCII letters and digits and of other characters'
bytes, in lower case).  Items whose runs of ``min_match`` tokens (the seeds) occur in a document are tiled against it:
the longest matches of tokens not yet tiled are marked first, found by Karp-Rabin hashes of falling length, down to
``min_match``.  An item leaks into a document if the tiles cover at least ``threshold`` of its tokens, in whatever
order and place.

The items are broadcast in blocks of at most ``block_bytes`` of text; a document passes through the blocks one after
another, with no shuffle.  Null texts have no tokens; items without a token never leak, and items shorter than
``min_match`` need a match of their whole length.  Rows are kept one for one.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.llm.common import byte_column, pieces, shingle_hashes, widened, word_hashes, word_spans

MIN_MATCH, THRESHOLD, BLOCK_BYTES = 4, 0.6, 32 << 20
_TOKEN = np.zeros(256, bool)
_TOKEN[48:58] = _TOKEN[97:123] = _TOKEN[128:] = True
_MOD = (1 << 61) - 1
_BASE = 0x1F3D5B79A7C9E1F3 % _MOD


def tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts and the text of each."""
    buf, off = byte_column(pa.array([(t or "").lower() for t in texts], pa.large_string()))
    starts, ends, row = word_spans(buf, off, _TOKEN)
    return word_hashes(buf, starts, ends), row


def _windows(seq: list[int], marked: list[bool], size: int):
    """Place and Karp-Rabin hash of each window of unmarked tokens."""
    top = pow(_BASE, size - 1, _MOD)
    h = run = 0
    for i, x in enumerate(seq):
        if marked[i]:
            h = run = 0
            continue
        if run >= size:
            h = (h - seq[i - size] * top) % _MOD
        h = (h * _BASE + x) % _MOD
        run += 1
        if run >= size:
            yield i - size + 1, h


def tile(item: list[int], text: list[int], min_match: int) -> list[tuple[int, int, int]]:
    """Tiles (place in the item, place in the text, length), the longest first.

    Windows of falling length find the maximal matches of unmarked tokens; ties go to the earliest places.
    """
    a, b = [False] * len(item), [False] * len(text)
    tiles, size = [], min(len(item), len(text))
    while size >= min_match:
        at: dict[int, list[int]] = {}
        for i, h in _windows(item, a, size):
            at.setdefault(h, []).append(i)
        found = []
        for j, h in _windows(text, b, size):
            for i in at.get(h, ()):
                if item[i:i + size] != text[j:j + size]:
                    continue
                if i and j and not a[i - 1] and not b[j - 1] and item[i - 1] == text[j - 1]:
                    continue  # part of a match that starts earlier
                n = size
                while i + n < len(item) and j + n < len(text) and not a[i + n] and not b[j + n] and item[i + n] == text[j + n]:
                    n += 1
                found.append((n, i, j))
        done = True
        for n, i, j in sorted(found, key=lambda x: (-x[0], x[1], x[2])):
            if any(a[i:i + n]) or any(b[j:j + n]):
                done = done and n <= size  # what is left of it may still be as long as a window
                continue
            a[i:i + n], b[j:j + n] = [True] * n, [True] * n
            tiles.append((i, j, n))
        if done:
            size = min_match if size <= 2 * min_match and size > min_match else size // 2 if size > min_match else 0
    return tiles


class Index:
    """Items of one block with their seeds."""

    def __init__(self, ids: list, texts: list[str | None], min_match: int):
        words, row = tokens(texts)
        n = np.bincount(row, minlength=len(ids)) if len(row) else np.zeros(len(ids), int)
        first = np.cumsum(n) - n
        self.ids, self.min_match = ids, min_match
        self.items = [[int(x) for x in words[f:f + k]] for f, k in zip(first, n, strict=True)]
        seeds, of = shingle_hashes(words, row, len(ids), min_match)
        # items shorter than a seed are one seed of their own length, kept apart by length
        order = np.lexsort((of, seeds))
        self.seeds, self.of = seeds[order], of[order]
        self.short = sorted({int(k) for k in n if 0 < k < min_match})

    def leaks(self, texts: list[str | None], threshold: float) -> list[list[tuple]]:
        """(item id, share covered) of the items that leak into each text, in order of coverage and id."""
        words, row = tokens(texts)
        out: list[list[tuple]] = [[] for _ in texts]
        if not len(words) or not len(self.seeds):
            return out
        n = np.bincount(row, minlength=len(texts))
        first = np.cumsum(n) - n
        pairs: dict[tuple[int, int], list[int]] = {}
        for width in (*self.short, self.min_match):
            h, of = shingle_hashes(words, row, len(texts), width)
            place = np.arange(len(h)) - np.searchsorted(of, of)
            lo = np.searchsorted(self.seeds, h)
            for k in np.flatnonzero((lo < len(self.seeds)) & (self.seeds[np.minimum(lo, len(self.seeds) - 1)] == h)):
                q = lo[k]
                while q < len(self.seeds) and self.seeds[q] == h[k]:
                    pairs.setdefault((int(of[k]), int(self.of[q])), []).append(int(place[k]))
                    q += 1
        for (r, i), places in pairs.items():
            item = self.items[i]
            least = min(self.min_match, len(item))
            # seeds cover at most this many tokens of the text, and tiles no more than seeds
            if len({p + k for p in places for k in range(least)}) < threshold * len(item):
                continue
            near = sorted({p + k for p in places for k in range(least) if p + k < n[r]})
            text: list[int] = []
            for k, p in enumerate(near):
                if k and p != near[k - 1] + 1:
                    text.append(-1 - k)  # a gap matches nothing
                text.append(int(words[first[r] + p]))
            covered = sum(t[2] for t in tile(item, text, least)) / len(item)
            if covered >= threshold:
                out[r].append((self.ids[i], covered))
        return [sorted(x, key=lambda y: (-y[1], y[0] is None, y[0] or 0)) for x in out]


def find_leaks(df: DataFrame, benchmark: DataFrame, text: str = "text", out: str = "leaks", min_match: int = MIN_MATCH, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``df`` with the column ``out``: item_id and coverage of the items (item_id, text) that leak into its texts."""
    spark = df.sparkSession
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(size / block_bytes * 1.5)) if size > block_bytes else 1
    kind = "array<struct<item_id:bigint,coverage:double>>"
    arrow = pa.list_(pa.struct([("item_id", pa.int64()), ("coverage", pa.float64())]))
    have = df.drop(out).withColumn(out, F.lit(None).cast(kind))
    for k in range(blocks):
        part = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).select(F.col("item_id").cast("long"), "text").distinct().toArrow()
        shared = spark.sparkContext.broadcast((part.column(0).to_pylist(), part.column(1).to_pylist()))

        def run(batches, shared=shared, last=k == blocks - 1):
            index = Index(*shared.value, min_match)
            for b in batches:
                at = b.schema.get_field_index(out)
                for i, j in pieces(byte_column(b.column(text))[1]):
                    p = b.slice(i, j - i)
                    got = index.leaks(p.column(text).to_pylist(), threshold)
                    rows = [[*(old or []), *({"item_id": x, "coverage": c} for x, c in new)] for old, new in zip(p.column(at).to_pylist(), got, strict=True)]
                    if last:
                        rows = [sorted(r, key=lambda x: (-x["coverage"], x["item_id"] is None, x["item_id"] or 0)) for r in rows]
                    cols = list(p.columns)
                    cols[at] = pa.array(rows, arrow)
                    yield pa.RecordBatch.from_arrays(cols, names=p.schema.names)

        have = have.mapInArrow(run, widened(df.drop(out), (out, kind)))
    return have


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated (0 or 1), n_items, item_ids by falling coverage and max_coverage of every row."""
    out = find_leaks(docs.select("doc_id", "text"), benchmark)
    return out.select(
        "doc_id", (F.size("leaks") > 0).cast("int").alias("contaminated"), F.size("leaks").cast("long").alias("n_items"),
        F.transform("leaks", lambda x: x["item_id"]).alias("item_ids"), F.coalesce(F.array_max(F.transform("leaks", lambda x: x["coverage"])), F.lit(0.0)).alias("max_coverage"),
    )
