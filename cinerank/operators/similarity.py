"""Item-item cosine similarity above a threshold, exact (blocked) or approximate (LSH).

Exact: vectors are spread over blocks by a hash of the row.  A task holds one block, about half of
the other blocks stream past it in Arrow batches, and only the pairs above the threshold leave it.
Memory per task is bounded by the block size, not by the catalogue; nothing is collected to the
driver and no row-level cross join is planned.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.functions.recs import recs_array
from cinerank.operators.ranking import top_n_per_group

EDGE_SCHEMA, CHUNKS = "mid int, rid int, r double", "mid int, chunk int, recs array<struct<rid:int,r:double>>"
#: Vectors that a task holds, about, and scores of a tile.
BLOCK_ROWS, TILE = 32_768, 1 << 21


def nonzero_vectors(vectors: DataFrame, id_col: str = "mid", vec_col: str = "features") -> DataFrame:
    """``(mid, _u)`` with ``_u`` the original vector; zero and null vectors are dropped.

    The tasks normalise in float64 after the shuffle, so a float vector is replicated with
    4 bytes per component; doubles stay doubles.
    """
    kind = vectors.schema[vec_col].dataType.simpleString()
    u = F.col(vec_col) if kind in ("array<float>", "array<double>") else F.col(vec_col).cast("array<double>")
    v = vectors.select(F.col(id_col).cast("int").alias("mid"), u.alias("_u"))
    sq = F.aggregate("_u", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return v.where(sq > 0)


def _matrix(column) -> np.ndarray:
    """The vectors of a list column as rows; all must have the same length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(column) and len(flat) % len(column):
        raise ValueError("vectors differ in length")
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _unit(column) -> tuple[np.ndarray, np.ndarray]:
    raw = _matrix(column)
    x = raw.astype(np.float64)
    return raw, x / np.linalg.norm(x, axis=1, keepdims=True)


def _ids(column) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64)


def stretches(batches):
    """(group, side, rows) of each stretch of a batch with one ``_g`` and one ``_side``."""
    for batch in batches:
        group, side = (batch.column(c).to_numpy() for c in ("_g", "_side"))
        cuts = np.r_[0, np.flatnonzero((np.diff(group) != 0) | (np.diff(side) != 0)) + 1, len(group)]
        for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if j > i:
                yield int(group[i]), int(side[i]), batch.slice(i, j - i)


def unit_vectors(vectors: DataFrame, id_col: str = "mid", vec_col: str = "features") -> DataFrame:
    """``(mid, _u)`` with ``_u`` the vector scaled to length 1 (double); zero and null vectors are dropped.

    A zero vector has an undefined cosine (NaN), which never passes ``> t``.
    """
    v = vectors.select(F.col(id_col).cast("int").alias("mid"), F.transform(vec_col, lambda x: x.cast("double")).alias("_v"))
    norm = F.sqrt(F.aggregate("_v", F.lit(0.0), lambda s, x: s + x * x))
    return (
        v.withColumn("_n", norm)
        .where(F.col("_n") > 0)
        .select("mid", F.transform("_v", lambda x: x / F.col("_n")).alias("_u"))
    )


def _share_bucket(hashes: np.ndarray | None, others: np.ndarray | None, ia: np.ndarray, ib: np.ndarray):
    """Whether a row and another have an equal hash in some table; without hashes every pair counts."""
    if hashes is None:
        return np.ones(len(ia), bool)
    hit = np.zeros(len(ia), bool)
    for mine, theirs in zip(hashes.T, others.T, strict=True):
        hit |= mine[ia] == theirs[ib]
    return hit


class _Block:
    """The rows of a block, and the pairs above the threshold that they form; of rows with hashes (``_h``) those that share a bucket."""

    def __init__(self, parts: list[pa.RecordBatch], threshold: float):
        rows = pa.Table.from_batches(parts)
        self.threshold, self.ids = threshold, _ids(rows.column("mid"))
        self.x, self.hashes = _unit(rows.column("_u"))[1], _matrix(rows.column("_h")) if "_h" in rows.column_names else None

    def _edges(self, found):
        """Both directions of the pairs found, in batches of about ``TILE`` rows."""
        parts, have = [], 0
        for a, b, r in found:
            if len(a):
                parts.append((a, b, r))
                have += len(a)
            if have > TILE:
                yield _both_ways(parts)
                parts, have = [], 0
        if parts:
            yield _both_ways(parts)

    def _found(self, ids, y, hashes, own: bool):
        step = max(1, TILE // len(ids))
        for i in range(0, len(self.ids), step):
            from_ = i if own else 0  # of the block itself each pair once
            s = self.x[i:i + step] @ y[from_:].T
            ia, ib = np.nonzero(s > self.threshold)
            r = s[ia, ib]
            ia, ib = ia + i, ib + from_
            keep = (self.ids[ia] != ids[ib]) & _share_bucket(self.hashes, hashes, ia, ib)
            if own:
                keep &= ia < ib
            yield self.ids[ia[keep]], ids[ib[keep]], r[keep]

    def inside(self):
        yield from self._edges(self._found(self.ids, self.x, self.hashes, True))

    def meet(self, part: pa.RecordBatch):
        hashes = _matrix(part.column("_h")) if self.hashes is not None else None
        yield from self._edges(self._found(_ids(part.column("mid")), _unit(part.column("_u"))[1], hashes, False))


def _both_ways(parts) -> pa.RecordBatch:
    a, b, r = (np.concatenate(c) for c in zip(*parts, strict=True))
    cols = [np.concatenate([a, b]).astype(np.int32), np.concatenate([b, a]).astype(np.int32), np.concatenate([r, r])]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["mid", "rid", "r"])


def _met(threshold: float):
    """Task function over a partition sorted by group and side: the rows of a block, then those of the blocks that it meets."""

    def run(batches):
        number, own, block = None, [], None
        for group, side, part in stretches(batches):
            if group != number:
                if own and block is None:
                    yield from _Block(own, threshold).inside()
                number, own, block = group, [], None
            if side == 0:
                own.append(part)
            elif own:  # a block without rows has no pair
                if block is None:
                    block = _Block(own, threshold)
                    yield from block.inside()
                yield from block.meet(part)
        if own and block is None:
            yield from _Block(own, threshold).inside()

    return run


def _compared(u: DataFrame, threshold: float, block_rows: int) -> DataFrame:
    """All pairs of the rows (mid, _u, and _h if there are hashes): a task holds a block and the blocks after it stream past.

    The number of blocks is odd and they lie in a ring: each meets the half of the others that follows it, so two blocks
    meet once.  A row travels once for every other block, of which there are as many as cores until the blocks are full.
    """
    n = u.count()
    groups = max(1, math.ceil(n / block_rows), min(n, u.sparkSession.sparkContext.defaultParallelism)) | 1
    blocked = u.withColumn("_b", F.pmod(F.xxhash64("mid", "_u"), F.lit(groups)).cast("int"))
    dealt = blocked.select("*", F.explode(F.sequence(F.lit(0), F.lit(groups // 2))).alias("_k")).select(
        *u.columns, F.pmod(F.col("_b") - F.col("_k"), F.lit(groups)).cast("int").alias("_g"), F.least("_k", F.lit(1)).alias("_side"),
    )
    return dealt.repartitionById(groups, F.col("_g")).sortWithinPartitions("_g", "_side").mapInArrow(_met(threshold), EDGE_SCHEMA)


def similar_pairs(
    vectors: DataFrame,
    threshold: float = 0.6,
    id_col: str = "mid",
    vec_col: str = "features",
    round_to: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """All ordered pairs ``(mid, rid, r)`` of different items with cosine ``r > threshold``.

    Both directions are returned.  With ``round_to`` the cosine is rounded (half up) before
    the threshold is applied, so rankings and thresholds agree with a rounded reference.
    Exact copies of an input row are collapsed, so each item pair appears once.
    """
    # exact copies of a row would all hash into one block; a pair of items is emitted once,
    # so copies are collapsed first (a partially aggregated distinct, skew-safe)
    u = nonzero_vectors(vectors, id_col, vec_col).dropDuplicates(["mid", "_u"])
    margin = 10.0 ** (-round_to) if round_to is not None else 0.0
    pairs = _compared(u, threshold - margin, block_rows)
    if round_to is not None:
        pairs = pairs.withColumn("r", F.round("r", round_to)).where(F.col("r") > F.lit(threshold))
    return pairs


def similar_pairs_lsh(
    vectors: DataFrame,
    threshold: float = 0.6,
    id_col: str = "mid",
    vec_col: str = "features",
    bucket_length: float | None = None,
    num_hash_tables: int = 8,
    seed: int = 7,
    round_to: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Approximate ``similar_pairs`` by random-projection LSH on unit vectors.

    For unit vectors ``cos > t`` is ``dist < sqrt(2 - 2t)``.  As in Spark's ``approxSimilarityJoin`` the pairs that share a
    bucket of some table and lie closer are returned, so every returned pair is exact but some may be missed.  Buckets are
    about as wide as the vectors' projections, so a join on them would make a row for nearly every pair and table: the
    hashes go with the vectors instead, and a pair above the threshold looks up its own inside the task that compares it.
    """
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector, vector_to_array

    u = unit_vectors(vectors, id_col, vec_col).where("mid is not null").dropDuplicates(["mid", "_u"]).withColumn("_vec", array_to_vector("_u"))
    radius = math.sqrt(max(0.0, 2.0 - 2.0 * threshold))
    lsh = BucketedRandomProjectionLSH(
        inputCol="_vec", outputCol="_hashes", bucketLength=bucket_length or max(radius, 1e-3) * 2,
        numHashTables=num_hash_tables, seed=seed,
    )
    hashed = lsh.fit(u).transform(u)
    h = F.array(*(vector_to_array(F.col("_hashes")[i])[0] for i in range(num_hash_tables)))
    out = _compared(hashed.select("mid", "_u", h.alias("_h")), threshold, block_rows)
    if round_to is not None:
        out = out.withColumn("r", F.round("r", round_to))
    return out.where((F.col("r") > F.lit(threshold)) & ~F.isnan("r"))


def similar_lists(edges, max_len: int | None = None) -> DataFrame:
    """Edges grouped per item: ``mid, recs`` ordered by ``r`` desc then ``rid``.

    The reference keeps every neighbour; ``max_len`` optionally cuts the list.  ``edges`` is a table of edges, or a
    ``lookup.SimilarityTable``, whose lists come whole from the tasks that compute them.
    """
    from cinerank.operators.lookup import SimilarityTable

    if isinstance(edges, SimilarityTable):
        lists = edges.lists()
        return lists if max_len is None else lists.withColumn("recs", F.slice("recs", 1, max_len))
    if max_len is None:
        # sort key (-r, rid) inside the list; no window needed
        return recs_array(edges.withColumn("_k", -F.col("r")), "mid", "rid", "r", "_k")
    ranked = top_n_per_group(edges, ["mid"], [F.desc("r"), F.asc("rid")], max_len)
    return recs_array(ranked, "mid", "rid", "r", "rank")


def similar_list_chunks(ranked: DataFrame, in_order: bool = False) -> DataFrame:
    """Lists of a ranked edge table (``online.ranked_edges``) in rows of one chunk each: ``mid, chunk, recs``.

    A hot item has many rows of bounded length; in the order of ``chunk`` they are ``similar_lists``.  ``in_order``: all rows
    of an item are in one partition, one after another by rank, as the tasks leave them that rank a
    ``lookup.SimilarityTable``; the chunks are then gathered as the rows pass and nothing is shuffled.
    """
    if in_order:
        rows = ranked.select(F.col("mid").cast("int"), F.col("chunk").cast("int"), F.col("rid").cast("int"), F.col("r").cast("double"))
        return rows.mapInArrow(_chunks, CHUNKS)
    each = F.struct(F.col("rank"), F.col("rid").cast("int").alias("rid"), F.col("r").cast("double").alias("r"))
    out = ranked.groupBy("mid", "chunk").agg(F.array_sort(F.collect_list(each)).alias("_l"))
    return out.select("mid", "chunk", F.transform("_l", lambda x: F.struct(x["rid"].alias("rid"), x["r"].alias("r"))).alias("recs"))


def _chunks(batches):
    """The lists of consecutive rows of one item and chunk; the last list of a batch may go on in the next."""
    kept = None
    for batch in batches:
        rows = pa.Table.from_batches([batch] if kept is None else [kept, batch]).combine_chunks()
        if not len(rows):
            continue
        mid, chunk = rows.column("mid").to_numpy(), rows.column("chunk").to_numpy()
        head = np.r_[0, np.flatnonzero((np.diff(mid) != 0) | (np.diff(chunk) != 0)) + 1]
        kept = rows.slice(head[-1]).to_batches()[0]
        if len(head) > 1:
            yield _gathered(rows.slice(0, head[-1]), head)
    if kept is not None:
        yield _gathered(pa.Table.from_batches([kept]), np.array([0, len(kept)]))


def _gathered(rows: pa.Table, ends: np.ndarray) -> pa.RecordBatch:
    rid, r = (rows.column(c).combine_chunks() for c in ("rid", "r"))
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([rid, r], names=["rid", "r"]))
    at = pa.array(ends[:-1])
    return pa.RecordBatch.from_arrays([rows.column(c).combine_chunks().take(at) for c in ("mid", "chunk")] + [lists], names=["mid", "chunk", "recs"])
