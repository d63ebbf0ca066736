"""Periodic runs of words: recursive frequency splitting, then a lag scan of what survives.

A run is a stretch of consecutive words with smallest period q, at least ``max(least, repeats * q)`` words long, that no
neighbouring word extends.  Each of its words stands in it ``repeats`` times at least, so a word that occurs more rarely in
a segment is in none of the segment's runs and splits it.  Splitting lowers the counts of the parts, so it is repeated
until nothing changes; ordinary prose is gone after a few rounds.  Segments that survive are scanned lag by lag: a run of
period q holds ``repeats - 1`` consecutive multiples of q whose words equal those q further on, so a lag probes only
every q-th word of a segment (n ln n probes for all lags) and extends what the probes find.

All texts of a batch are split and scanned at once.  A null text counts as empty and has no runs.  Rows, repeated ones
too, are kept one for one; result names replace columns of the same name.  Words are compared whole, not by hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cinerank.llm.common import byte_column, pieces, widened, word_spans

LEAST, REPEATS = 6, 4


def word_numbers(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word, equal for equal words."""
    n = ends - starts
    offsets = np.concatenate([[0], np.cumsum(n)])
    at = np.repeat(starts - offsets[:-1], n) + np.arange(offsets[-1])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(buf[at].tobytes())])
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def split_rare(word: np.ndarray, segment: np.ndarray, least: int = LEAST, repeats: int = REPEATS) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the stretches of ``word`` in which every word occurs ``repeats`` times or more.

    ``segment`` numbers the stretch that each word belongs to at first (its text), in order.
    """
    kinds = int(word.max(initial=0)) + 1
    at, seg = np.arange(len(word)), segment
    done = []
    while len(at):
        length = np.bincount(seg)
        keep = length[seg] >= least
        at, seg = at[keep], seg[keep]
        if not len(at):
            break
        _, which, count = np.unique(seg * kinds + word[at], return_inverse=True, return_counts=True)
        rare = count[which] < repeats
        split = np.zeros(int(seg.max()) + 1, bool)
        split[seg[rare]] = True
        whole = ~split[seg]
        done.append(_stretches(at[whole], segment))
        go = ~whole & ~rare
        at, seg = at[go], seg[go]
        # a gap or another segment begins a new one
        seg = np.cumsum(np.r_[False, (np.diff(at) > 1) | (np.diff(seg) != 0)]) if len(at) else seg
    if not done:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    both = np.concatenate(done)
    return both[:, 0], both[:, 1]


def _stretches(at: np.ndarray, segment: np.ndarray) -> np.ndarray:
    """Rows (start, end) of the maximal ranges of ascending positions of one text."""
    if not len(at):
        return np.zeros((0, 2), np.int64)
    first = np.flatnonzero(np.r_[True, (np.diff(at) > 1) | (np.diff(segment[at]) != 0)])
    last = np.r_[first[1:], len(at)] - 1
    return np.stack([at[first], at[last] + 1], axis=1)


def _reach(word: np.ndarray, p: int, q: int, low: int, high: int) -> tuple[int, int]:
    """The maximal stretch of period q around the match of p and p + q, inside [low, high)."""
    left, step = p, 32
    while left > low:
        i = max(low, left - step)
        bad = np.flatnonzero(word[i:left] != word[i + q:left + q])
        if len(bad):
            left = i + int(bad[-1]) + 1
            break
        left, step = i, 4 * step
    right, step = p, 32
    while right < high - q:
        j = min(high - q, right + step)
        bad = np.flatnonzero(word[right:j] != word[right + q:j + q])
        if len(bad):
            right += int(bad[0])
            break
        right, step = j, 4 * step
    return left, right + q


def lag_scan(word: np.ndarray, start: np.ndarray, end: np.ndarray, least: int = LEAST, repeats: int = REPEATS) -> list[tuple[int, int, int]]:
    """(start, end, period) of every run inside the segments, by ascending period.

    A stretch that also has a multiple of its period is met again at that lag, with the same ends; the first lag stays.
    """
    order = np.argsort(start - end, kind="stable")
    start, end = start[order], end[order]
    length = end - start
    found: dict[tuple[int, int], int] = {}
    run_period, run_end = np.zeros(len(word), np.int64), np.zeros(len(word), np.int64)
    for q in range(1, int(length.max(initial=0)) // repeats + 1):
        live = int(np.searchsorted(-length, -max(least, repeats * q), side="right"))
        if not live:
            break
        s, e = start[:live], end[:live]
        n = (e - 1 - s) // q - (repeats - 2)
        which = np.repeat(np.arange(live), n)
        p = s[which] + q * (np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n))
        for k in range(repeats - 1):
            hit = word[p + k * q] == word[p + (k + 1) * q]
            p, which = p[hit], which[hit]
        # a match inside a run whose period divides q belongs to that run
        known = (run_period[p] > 0) & (q % np.maximum(run_period[p], 1) == 0) & (p + q < run_end[p])
        p, which = p[~known], which[~known]
        # all words between the first and the last multiple must match too: a few of them tell most accidents apart
        for k in (q // 2, q // 3, q // 5, q + q // 2, q + q // 3):
            if k < (repeats - 2) * q:
                hit = word[p + k] == word[p + k + q]
                p, which = p[hit], which[hit]
        past, of = 0, -1
        for at, w in zip(p.tolist(), which.tolist(), strict=True):
            if w == of and at < past:
                continue
            low, high = int(s[w]), int(e[w])
            a, b = _reach(word, at, q, low, high)
            if b - a >= max(least, repeats * q):
                past, of = b - q, w  # every further match at this lag up to here is the same run
                found.setdefault((a, b), q)
                run_period[a:b], run_end[a:b] = q, b
    return [(a, b, q) for (a, b), q in found.items()]


def collapse(buf: np.ndarray, off: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: np.ndarray, keep: np.ndarray) -> pa.Array:
    """The kept words of each row, joined by one space."""
    s, e, r = starts[keep], ends[keep], row[keep]
    mark = np.zeros(len(buf) + 1, np.int8)
    mark[s] += 1
    mark[e] -= 1
    take = np.cumsum(mark, dtype=np.int8)[:-1].astype(bool)
    follows = np.r_[r[1:] == r[:-1], False] if len(r) else np.zeros(0, bool)
    gap = e[follows]  # the byte after a word that another one follows is white space
    out = buf.copy()
    out[gap] = 0x20
    take[gap] = True
    sizes = np.concatenate([[0], np.cumsum(take)])[off]
    return pa.LargeStringArray.from_buffers(len(off) - 1, pa.py_buffer(sizes.astype(np.int64).tobytes()), pa.py_buffer(out[take].tobytes())).cast(pa.string())


RUN = "array<struct<start: long, length: long, period: long>>"


def _piece(texts, least: int, repeats: int) -> list[pa.Array]:
    buf, off = byte_column(texts)
    starts, ends, row = word_spans(buf, off)
    rows = len(off) - 1
    word = word_numbers(buf, starts, ends)
    lag = lag_scan(word, *split_rare(word, row, least, repeats), least, repeats)
    runs = np.array(lag, np.int64).reshape(-1, 3)
    of = row[runs[:, 0]]
    order = np.lexsort((runs[:, 2], runs[:, 0], of))
    runs, of = runs[order], of[order]
    drop = np.zeros(len(word) + 1, np.int64)
    np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
    np.add.at(drop, runs[:, 1], -1)
    first = np.searchsorted(row, np.arange(rows))
    fields = [runs[:, 0] - first[of] if len(of) else of, runs[:, 1] - runs[:, 0], runs[:, 2]]
    structs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in fields], names=["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(rows + 1)), pa.int32()), structs)
    return [
        pa.array(np.bincount(row, minlength=rows), pa.int64()), lists,
        collapse(buf, off, starts, ends, row, np.cumsum(drop)[:-1] == 0),
    ]


def find_runs(df: DataFrame, text: str = "text", least: int = LEAST, repeats: int = REPEATS) -> DataFrame:
    """``df`` with n_words, runs (by start, then period) and collapsed: the words but for those after a run's first period.

    ``repeats`` is 3 or more.  One pass over the rows, no shuffle; a batch is worked on in pieces of bounded size, or one
    longer text.
    """
    if repeats < 3:
        raise ValueError("repeats must be 3 or more")
    names = ["n_words", "runs", "collapsed"]
    kept = df.drop(*(n for n in names if n != text))
    if text in names:
        raise ValueError(f"the text must not be called like a result: {names}")

    def run(batches):
        for batch in batches:
            for i, j in pieces(byte_column(batch.column(text))[1]):
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*part.columns, *_piece(part.column(text), least, repeats)], names=[*part.schema.names, *names])

    return kept.mapInArrow(run, widened(kept, ("n_words", "long"), ("runs", RUN), ("collapsed", "string")))
