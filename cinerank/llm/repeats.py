"""Removal of byte strings that occur earlier in the corpus.

Every byte covered by a string of ``LENGTH`` bytes that also starts earlier (in a smaller id, or earlier in the same
text) goes; strings never cross texts, overlaps count, and all is judged on the input.  Rows of one id stand in the
order of the table, null ids last.

The method keeps the idea of the difference-cover construction of suffix arrays, for prefixes of fixed length: a sample of
positions is named, names are compared first, and the positions between follow from the sample.  It has no recursion on
names and no merge of suffixes, and equal fingerprints count as equal strings.  The cover is chosen
by content: in every window of ``LENGTH`` bytes the position whose ``GRAM`` bytes have the smallest hash, so two equal
windows always sample the same place, at a density of 1 in 19 instead of 2 in 3.  Names are Karp-Rabin fingerprints
(two primes, 62 bits).  Sampled grams that occur once end the comparison at once; around those that repeat, the
stretch of windows that share a sampled position is halved and each half named by what its windows share; equal
stretches yield to the earliest, and only where stretches of one name differ are the windows themselves named, sorted by name and position, and compared with the first
of their name.  Hot strings are summed before each shuffle.

Null and empty texts lose nothing.  Rows are kept one for one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinerank.llm.blocks import pack, payloads
from cinerank.llm.common import byte_column, settle
from cinerank.session import remove_path

LENGTH, GRAM = 100, 64
_PRIMES = ((2147483647, 1000003, 1), (2147483629, 16777619, 2))


def _powers(n: int, p: int, base: int) -> np.ndarray:
    """base**i modulo p for i < n."""
    out = np.ones(max(1, n), np.int64)
    have = 1
    while have < n:
        step = pow(base, have, p)
        more = min(have, n - have)
        out[have:have + more] = out[:more] * step % p
        have += more
    return out


class Prints:
    """Fingerprints of the substrings of a text, modulo two primes."""

    def __init__(self, buf: np.ndarray):
        self.sums, self.back = [], []
        x = buf.astype(np.int64) + 1
        for p, base, _ in _PRIMES:
            power = _powers(len(x) + 1, p, base)
            terms = x * power[:len(x)] % p
            s = np.concatenate([[0], np.cumsum(terms)]) % p if len(x) < (1 << 31) else None
            self.sums.append(s)
            self.back.append(_powers(len(x) + 1, p, pow(base, -1, p)))

    def of(self, start: np.ndarray, size) -> np.ndarray:
        out = []
        for (p, _, _), s, back in zip(_PRIMES, self.sums, self.back, strict=True):
            out.append((s[start + size] - s[start]) % p * back[start] % p)
        return (out[0] << 31) | out[1]


def _scramble(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        y = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        y = (y ^ (y >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return y ^ (y >> np.uint64(32))


def sampled(prints: Prints, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last window, sampled position and its gram's name of each stretch of windows that sample one place."""
    windows = n - LENGTH + 1
    if windows < 1:
        e = np.zeros(0, np.int64)
        return e, e, e, e
    names = prints.of(np.arange(n - GRAM + 1), GRAM)
    rank = _scramble(names)
    width = LENGTH - GRAM + 1
    # smallest value of each window and its leftmost place, by doubling
    low, at, have = rank, np.arange(len(rank)), 1
    while have < width:
        step = min(have, width - have)
        right = low[step:] < low[:len(low) - step]
        low = np.where(right, low[step:], low[:len(low) - step])
        at = np.where(right, at[step:], at[:len(at) - step])
        have += step
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    last = np.append(first[1:], windows) - 1
    return first, last, at[first], names[at[first]]


def _rows(table: pa.Table):
    """Row and bytes of each text long enough for a window."""
    buf, off = byte_column(table.column("text"))
    for r in np.flatnonzero(np.diff(off) >= LENGTH):
        yield int(r), buf[off[r]:off[r + 1]]


def ask_names(blocks: DataFrame) -> DataFrame:
    """block, name and count of the sampled grams of each block."""

    def run(batches):
        for block, table, _ in payloads(batches):
            names, counts = [], []
            for _, buf in _rows(table):
                u, c = np.unique(sampled(Prints(buf), len(buf))[3], return_counts=True)
                names.append(u)
                counts.append(c)
            if names:
                u, back = np.unique(np.concatenate(names), return_inverse=True)
                c = np.bincount(back, np.concatenate(counts), len(u)).astype(np.int64)
                yield pa.record_batch([pa.array(np.full(len(u), block)), pa.array(u), pa.array(c)], names=["block", "name", "n"])

    return blocks.mapInArrow(run, "block long, name long, n long")


def _halves(prints: Prints, first: np.ndarray, last: np.ndarray, place: np.ndarray):
    """Name, whole, first and last of the stretches cut in two: each half is named by the longer string that all its windows share."""
    near = (LENGTH - GRAM) // 2
    out = []
    for f, e, start, size, salt in (
        (np.maximum(first, place - near), last, place, LENGTH - near, 0),
        (first, np.minimum(last, place - near - 1), place - near - 1, GRAM + near + 1, 1),
    ):
        ok = f <= e
        f, e = f[ok], e[ok]
        name = _scramble(prints.of(start[ok], size) ^ salt)
        whole = _scramble(prints.of(f, e - f + LENGTH)) ^ (e - f).astype(np.uint64) * np.uint64(0xD1342543DE82EF95)
        out.append((name.astype(np.int64), whole.astype(np.int64), f, e))
    return [np.concatenate(x) for x in zip(*out, strict=True)]


_NO_STRETCH = [np.zeros(0, np.int64)] * 4


def _repeated_stretches(buf: np.ndarray, hot: np.ndarray) -> list[np.ndarray]:
    """The halves of the stretches of a text whose sampled gram is among the names in ``hot`` (in order)."""
    prints = Prints(buf)
    first, last, place, name = sampled(prints, len(buf))
    keep = hot[np.minimum(np.searchsorted(hot, name), len(hot) - 1)] == name
    return _halves(prints, first[keep], last[keep], place[keep]) if keep.any() else _NO_STRETCH


def stretches(blocks: DataFrame, repeated: DataFrame) -> DataFrame:
    """loc (place in the table), id, n_bytes, digest (of the whole text), text (compressed, only where stretches repeat) and these stretches."""
    asked = blocks.join(repeated, "block", "left").select("block", "payload", "names")

    def run(batches):
        pack_ = zstandard.ZstdCompressor(level=3).compress
        for block, table, facts in payloads(batches):
            hot = np.sort(facts.column("names")[0].values.to_numpy()) if facts.column("names")[0].is_valid else np.zeros(0, np.int64)
            ids, (buf, off) = table.column("id").combine_chunks(), byte_column(table.column("text"))
            base = ((block >> 32) << 39) | ((block & 0xFFFFFFFF) << 20)
            i, digests, packed, found, have = 0, [], [], [], 0
            for r in range(len(table)):
                t = buf[off[r]:off[r + 1]]
                digests.append(hashlib.sha256(t).hexdigest())
                parts = _repeated_stretches(t, hot) if len(hot) and len(t) >= LENGTH else _NO_STRETCH
                found.append(parts)
                packed.append(pack_(t.tobytes()) if len(parts[0]) else None)
                have += len(parts[0])
                # a batch of bounded size: what the texts before asked for is let go
                if have > 100_000 or len(digests) == 2_000 or r == len(table) - 1:
                    ends = np.cumsum([0, *(len(x[0]) for x in found)])
                    fields = [pa.array(np.concatenate(c), k) for c, k in zip(zip(*found, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)]
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, names=["name", "whole", "first", "last"]))
                    cols = [pa.array(base | np.arange(i, r + 1)), ids.slice(i, r + 1 - i), pa.array(np.diff(off[i:r + 2])), pa.array(digests, pa.string()), pa.array(packed, pa.binary()), lists]
                    yield pa.record_batch(cols, names=["loc", "id", "n_bytes", "digest", "text", "stretches"])
                    i, digests, packed, found, have = r + 1, [], [], [], 0

    return asked.mapInArrow(run, "loc long, id long, n_bytes long, digest string, text binary, stretches array<struct<name:bigint,whole:bigint,first:int,last:int>>")


def _plain(payload: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), np.uint8)


def _windows(texts: DataFrame) -> DataFrame:
    """A row for each window of the stretches asked for; its name takes in that of the gram."""

    def run(batches):
        for b in batches:
            for k in range(len(b)):
                prints = Prints(_plain(b.column("text")[k].as_py()))
                s = b.column("asked")[k].values
                first, last = s.field("first").to_numpy().astype(np.int64), s.field("last").to_numpy().astype(np.int64)
                n = last - first + 1
                at = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                name = np.repeat(_scramble(s.field("name").to_numpy()), n)
                full = lambda c: pa.array(np.full(len(at), b.column(c)[k].as_py()))  # noqa: B023, E731
                window = (name ^ prints.of(at, LENGTH).astype(np.uint64)).astype(np.int64)
                yield pa.record_batch([full("loc"), full("id"), pa.array(window), pa.array(at.astype(np.int32))], names=["loc", "id", "window", "at"])

    return texts.mapInArrow(run, "loc long, id long, window long, at int")


def _cut(rows: DataFrame) -> DataFrame:
    """id, n_bytes, n_removed, n_spans and kept of texts with the windows (first, last) to remove."""

    def run(batches):
        for b in batches:
            for k in range(len(b)):
                buf = _plain(b.column("text")[k].as_py())
                v = b.column("gone")[k].values
                edge = np.zeros(len(buf) + 1, np.int64)
                np.add.at(edge, v.field("first").to_numpy(), 1)
                np.add.at(edge, v.field("last").to_numpy().astype(np.int64) + LENGTH, -1)
                gone = np.cumsum(edge)[:-1] > 0
                spans = int((gone & ~np.append(False, gone[:-1])).sum())
                row = (b.column("id")[k].as_py(), len(buf), int(gone.sum()), spans, buf[~gone].tobytes())
                yield pa.record_batch([pa.array([x], t) for x, t in zip(row, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["id", "n_bytes", "n_removed", "n_spans", "kept"])

    return rows.mapInArrow(run, "id long, n_bytes long, n_removed long, n_spans long, kept binary")


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The key (long), n_bytes, n_removed, n_spans, kept_sha256 and, where bytes went, kept (the bytes left) of each row."""
    spark = docs.sparkSession
    own = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    blocks, blocks_at = pack(own, "repeat-blocks")
    # a name has a row a block at most
    shared = ask_names(blocks).withColumn("all", F.sum("n").over(Window.partitionBy("name"))).where("all > 1")
    repeated = shared.groupBy("block").agg(F.collect_list("name").alias("names"))
    texts, _ = settle(stretches(blocks, repeated), "repeat-texts")
    remove_path(spark, blocks_at)

    # null ids stand behind all others, which sorting null as the largest number gives
    order = F.coalesce("id", F.lit((1 << 63) - 1)).alias("id")
    each = texts.where(F.size("stretches") > 0).select("loc", order, F.explode("stretches").alias("s")).select(
        "s.name", "s.whole", F.struct("id", "loc", F.col("s.first").alias("first")).alias("place"), F.col("s.last").alias("last"))
    classes, classes_at = settle(each.groupBy("name", "whole").agg(F.min(F.struct("place", "last")).alias("head")), "repeat-classes")
    heads = classes.select("name", "whole", F.col("head.place").alias("head"))
    later = each.join(heads, ["name", "whole"]).where(F.col("place") != F.col("head")).select("place.loc", "place.first", "last")
    # grams around which texts differ: the first stretches of each kind are compared window by window
    several = classes.groupBy("name").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("name")
    open_ = classes.join(several, "name", "left_semi").select("name", "head.place.loc", "head.place.first", "head.last")
    wanted = open_.groupBy("loc").agg(F.collect_list(F.struct("name", "first", "last")).alias("asked"))
    windows, windows_at = settle(_windows(texts.where("text is not null").select("loc", order, "text").join(wanted, "loc")), "repeat-windows")
    at = F.struct("id", "loc", "at")
    firsts = windows.groupBy("window").agg(F.min(at).alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1").select("window", "head")
    same = windows.join(firsts, "window").where(at != F.col("head")).select("loc", F.col("at").alias("first"), F.col("at").alias("last"))
    gone, _ = settle(later.unionByName(same).groupBy("loc").agg(F.collect_list(F.struct("first", "last")).alias("gone")), "repeat-gone")
    for path in (classes_at, windows_at):
        remove_path(spark, path)
    cut = _cut(texts.where("text is not null").select("loc", "id", "text").join(gone, "loc").select("id", "text", "gone"))
    whole = texts.select("loc", "id", "n_bytes", "digest").join(gone.select("loc"), "loc", "left_anti").select("id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.col("digest").alias("kept_sha256"), F.lit(None).cast("binary").alias("kept"))
    changed = cut.select("id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "kept")
    return whole.unionByName(changed).withColumnRenamed("id", key)
