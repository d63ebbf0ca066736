"""Helpers shared by the operators: table readers, Arrow byte columns, vectorised word spans and hashes."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cinerank.session import scratch_path

#: Bytes of text worked on at once inside a task; arrays of 8 bytes a position stay small beside it.
PIECE = 512 << 10

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fold(n: int, key: str = "doc_id") -> Column:
    """crc32 of the key as text, modulo n; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % n


def fold_of(key, n: int) -> int:
    return zlib.crc32(b"" if key is None else str(key).encode()) % n


def byte_column(col) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary Arrow column, and the n + 1 offsets of its rows; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64)[col.offset:col.offset + len(col) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def pieces(off: np.ndarray, limit: int = PIECE):
    """Ranges (i, j) of consecutive rows with at most ``limit`` bytes together, or one longer row."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def lower(buf: np.ndarray) -> np.ndarray:
    """A-Z in lower case; all other bytes as they are."""
    return _LOWER[buf]


def word_spans(buf: np.ndarray, off: np.ndarray, letters: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every maximal run of bytes other than white space, or of the bytes marked in ``letters``.

    No word crosses a row's end.
    """
    inside = ~_SPACE[buf] if letters is None else letters[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[off] = True
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(off, starts, side="right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def coefficients(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit multipliers."""
    with np.errstate(over="ignore"):
        x = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(seed)
        return mix(x) | np.uint64(1)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, equal for equal words wherever they stand."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lens = ends - starts
    first = np.cumsum(lens) - lens
    at = np.arange(int(lens.sum()), dtype=np.int64) - np.repeat(first, lens)
    chars = buf[at + np.repeat(starts, lens)].astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        sums = np.add.reduceat(chars * coefficients(int(lens.max()), 1)[at], first)
        return mix(sums + lens.astype(np.uint64))


def shingle_hashes(words: np.ndarray, row: np.ndarray, rows: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words inside a row, and the row of each, in order.

    A row with fewer words, but at least one, has a single shingle of all its words.
    """
    n = np.bincount(row, minlength=rows)
    first = np.cumsum(n) - n
    c = coefficients(width, 2)
    with np.errstate(over="ignore"):
        h = np.zeros(max(0, len(words) - width + 1), np.uint64)
        for k in range(width):
            h += words[k:len(words) - width + 1 + k] * c[k] if len(h) else h
        whole = row[:len(h)] == row[width - 1:] if len(h) else np.zeros(0, bool)
        out, of = mix(h[whole]), row[:len(h)][whole]
        short = np.flatnonzero((n > 0) & (n < width))
        if len(short):
            extra = [mix(np.array([(words[first[r]:first[r] + n[r]] * c[:n[r]]).sum()], np.uint64))[0] for r in short]
            out, of = np.concatenate([out, np.array(extra, np.uint64)]), np.concatenate([of, short])
            order = np.argsort(of, kind="stable")
            out, of = out[order], of[order]
    return out, of


def widened(df: DataFrame, *columns: tuple[str, str]) -> StructType:
    """The schema of ``df`` with more columns."""
    return StructType(df.schema.fields + StructType.fromDDL(", ".join(f"`{n}` {kind}" for n, kind in columns)).fields)


def aside(df: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with the columns called like one of the names renamed, and the new names by the old ones."""
    taken, new = {c.lower() for c in df.columns} | set(names), {}
    for c in df.columns:
        if c.lower() in names:
            free = c + "_"
            while free.lower() in taken:
                free += "_"
            taken.add(free.lower())
            new[c] = free
    return df.withColumnsRenamed(new), new


def settle(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder and read back, and its path.

    Collecting the driver's garbage lets Spark's cleaner delete the shuffle files of the job, which nothing needs any
    more; otherwise they stay until the driver happens to collect.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    df.sparkSession.sparkContext._jvm.System.gc()
    return df.sparkSession.read.parquet(path), path
