"""Near duplicates by word shingles: MinHash candidates, Bayesian pruning, exact verification.

Texts are sets of shingles of five words (runs of bytes other than white space, A-Z in lower case; a text of fewer
words is one shingle).  Texts with the same words are one node.  Nodes that agree on one of ``BANDS`` bands of
``ROWS`` MinHash values share a bucket (a pair of similarity 0.8 escapes with probability 5e-6).  The members of a bucket
are dealt into sides of about ``SIDE`` by a salt, and one task compares two sides on the low bytes of their MinHash values,
sixteen at a time: a pair is dropped once the posterior probability (uniform prior) that its similarity reaches the
threshold falls below ``TOLERANCE`` (low bytes that agree by accident only keep a pair longer).  The rest are verified on
the texts.  Sketches travel to the buckets, pairs do not.

In the first rounds each node puts forward only its most alike partner of another class, so a group of n near copies takes
n verifications; what shares a bucket but not yet a class is then compared in full, each pair from the first band that its
nodes share.  Thus no link between different classes is lost.  ``n_links`` counts for each node all other nodes that reach
the threshold: once the classes are settled, the nodes of a class are dealt into sides too, side is compared with side in
one task by exact counts of common shingles, and only each node's number of links leaves it.

Null and empty texts are classes of their own (each row; the class of a row with a null id is then null).  Rows are
kept one for one, repeated ones too.  Intermediate tables lie in the shared folder and go once they have been read.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.llm.common import aside, byte_column, coefficients, lower, mix, pieces, settle, shingle_hashes, widened, word_hashes, word_spans
from cinerank.session import remove_path

WIDTH, THRESHOLD, BANDS, ROWS, STEP, TOLERANCE = 5, 0.8, 40, 6, 16, 1e-4
HASHES = BANDS * ROWS
#: Nodes in a side of a bucket, about, rows compared at once, values by which a node's partners are ranked, and partners
#: that all values then decide among.
SIDE, TILE, RANKED, TOP = 2048, 256, 32, 8
#: Nodes and bytes of text in a side of a class, about; and shingles counted at once.
CLASS_SIDE, SIDE_BYTES, COLUMNS = 512, 8 << 20, 4096


class Tables:
    """Written tables of one run, removed once they have been read."""

    def __init__(self):
        self.paths: dict[int, tuple[DataFrame, str]] = {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        out, path = settle(df, name)
        self.paths[id(out)] = (out, path)
        return out

    def drop(self, *dfs: DataFrame) -> None:
        for df in dfs:
            _, path = self.paths.pop(id(df))
            remove_path(df.sparkSession, path)

    def drop_all(self) -> None:
        self.drop(*(df for df, _ in list(self.paths.values())))


def _digests(words: np.ndarray, row: np.ndarray, rows: int) -> list[bytes | None]:
    """128 bits of each row's sequence of words; None without a word."""
    n = np.bincount(row, minlength=rows)
    place = np.arange(len(words)) - np.repeat(np.cumsum(n) - n, n)
    some = np.flatnonzero(n)
    out: list[bytes | None] = [None] * rows
    if len(some):
        head = (np.cumsum(n) - n)[some]
        with np.errstate(over="ignore"):
            both = np.empty((len(some), 2), np.uint64)
            for k in range(2):
                sums = np.add.reduceat(mix(words + coefficients(1, 11 + k)[0]) * coefficients(int(n.max()), 21 + k)[place], head)
                both[:, k] = mix(sums + n[some].astype(np.uint64))
        for r, x in zip(some.tolist(), both, strict=True):
            out[r] = x.tobytes()
    return out


def _minhash(shingles: np.ndarray, of: np.ndarray, rows: int) -> list[tuple[bytes, bytes, bytes] | None]:
    """The low bytes of each row's MinHash values, a number of 64 bits for each of its bands, and their low 32 bits."""
    n = np.bincount(of, minlength=rows)
    some = np.flatnonzero(n)
    out: list[tuple[bytes, bytes, bytes] | None] = [None] * rows
    if len(some):
        head = (np.cumsum(n) - n)[some]
        values = np.empty((len(some), HASHES), "<u4")
        with np.errstate(over="ignore"):
            for k, c in enumerate(coefficients(HASHES, 31)):
                values[:, k] = np.minimum.reduceat((shingles * c) >> np.uint64(32), head)
            mixed = mix(values.astype(np.uint64) + np.uint64(1)) * coefficients(HASHES, 41)
            bands = mix(mixed.reshape(len(some), BANDS, ROWS).sum(axis=2))
        for r, v, b in zip(some.tolist(), values.astype(np.uint8), bands, strict=True):
            out[r] = v.tobytes(), b.tobytes(), b.astype("<u4").tobytes()
    return out


def sketch(df: DataFrame, text: str = "text", values: bool = True) -> DataFrame:
    """``df`` with ``node`` (16 bytes that stand for the words) and, if wanted, ``minhash``, ``bands`` and ``marks``; null without a word."""
    names = ["node"] + (["minhash", "bands", "marks"] if values else [])

    def run(batches):
        for b in batches:
            buf, off = byte_column(b.column(text))
            for i, j in pieces(off):
                own, start = lower(buf[off[i]:off[j]]), off[i:j + 1] - off[i]
                s, e, row = word_spans(own, start)
                words = word_hashes(own, s, e)
                cols = [pa.array(_digests(words, row, j - i), pa.binary())]
                if values:
                    both = _minhash(*shingle_hashes(words, row, j - i, WIDTH), j - i)
                    cols += [pa.array([x and x[k] for x in both], pa.binary()) for k in range(3)]
                yield pa.RecordBatch.from_arrays([*b.slice(i, j - i).columns, *cols], names=[*b.schema.names, *names])

    return df.mapInArrow(run, widened(df, *((n, "binary") for n in names)))


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """For each number of values compared, the fewest matches at which a pair stays."""

    def posterior(m: int, n: int) -> float:
        # Beta(m + 1, n - m + 1) above the threshold is a binomial tail
        return sum(comb(n + 1, j) * threshold**j * (1 - threshold) ** (n + 1 - j) for j in range(m + 1))

    return {n: next(m for m in range(n + 1) if posterior(m, n) >= tolerance) for n in range(STEP, HASHES + 1, STEP)}


def _packed(df: DataFrame, text: str) -> DataFrame:
    """``node``, ``packed`` (the text, compressed) and ``size`` (its bytes)."""

    def run(batches):
        pack = zstandard.ZstdCompressor(level=3).compress
        for b in batches:
            buf, off = byte_column(b.column(text))
            texts = [pack(buf[off[i]:off[i + 1]].tobytes()) for i in range(len(b))]
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(texts, pa.binary()), pa.array(np.diff(off))], names=["node", "packed", "size"])

    return df.select("node", text).mapInArrow(run, "node binary, packed binary, size long")


def verify(pairs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """a, b and similarity of the pairs of compressed texts (x, y) that reach the threshold."""

    def shingle_set(packed: bytes) -> np.ndarray:
        own = lower(np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8))
        s, e, row = word_spans(own, np.array([0, len(own)]))
        return np.unique(shingle_hashes(word_hashes(own, s, e), row, 1, WIDTH)[0])

    def run(batches):
        last, kept = None, None
        for t in batches:
            out: list[tuple] = []
            x, y = t.column("x"), t.column("y")
            for k, (a, b) in enumerate(zip(t.column("a").to_pylist(), t.column("b").to_pylist(), strict=True)):
                if a != last:
                    last, kept = a, shingle_set(x[k].as_py())
                other = shingle_set(y[k].as_py())
                common = len(np.intersect1d(kept, other, assume_unique=True))
                if common >= threshold * (len(kept) + len(other) - common):
                    out.append((a, b, common / (len(kept) + len(other) - common)))
            cols = list(zip(*out, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(cols, (pa.binary(), pa.binary(), pa.float64()), strict=True)], names=["a", "b", "similarity"])

    return pairs.mapInArrow(run, "a binary, b binary, similarity double")


def components(links: DataFrame, tables: Tables) -> DataFrame:
    """node and comp (its smallest node) of the nodes of the links (a, b), by smallest labels and pointer jumping."""
    both = tables.keep(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = tables.keep(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("comp")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        step = labels.join(near, "node").select("node", F.least("comp", "near").alias("next"), "comp")
        jump = step.join(labels.select(F.col("node").alias("next"), F.col("comp").alias("far")), "next", "left")
        new = tables.keep(jump.select("node", F.least(F.col("next"), F.coalesce("far", "next")).alias("comp"), (F.col("comp") != F.least(F.col("next"), F.coalesce("far", "next"))).alias("moved")), "labels")
        tables.drop(labels)
        if new.where("moved").isEmpty():
            tables.drop(both)
            return new
        labels = new


def _verified(alive: DataFrame, texts: DataFrame, tables: Tables) -> DataFrame:
    """The links among the pairs (a, b) that the pruning left."""
    alive = tables.keep(alive, "alive")
    side = lambda k, v: texts.select(F.col("node").alias(k), F.col("packed").alias(v))
    out = tables.keep(verify(alive.join(side("b", "y"), "b").join(side("a", "x"), "a").select("a", "b", "x", "y")), "links")
    tables.drop(alive)
    return out


def _sides(rows: DataFrame, group: list[str], size) -> DataFrame:
    """``rows`` dealt by a salt into sides of their group, a row for each side it meets: side, low and high besides."""
    sides = rows.groupBy(*group).agg(size.cast("int").alias("sides"))
    dealt = rows.join(sides, group).withColumn("side", F.pmod(F.xxhash64("node"), F.col("sides")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
    return dealt.withColumn("low", F.least("side", "other")).withColumn("high", F.greatest("side", "other")).drop("sides", "other")


def _values(t: pa.Table, column: str, kind: str) -> np.ndarray:
    return np.frombuffer(byte_column(t.column(column))[0].tobytes(), kind).reshape(len(t), -1)


def _alike(values: np.ndarray, rows: np.ndarray, others: np.ndarray, comp: np.ndarray, upto: int, least: dict[int, int]):
    """For a tile of rows: which of the others may reach the threshold by the first ``upto`` values, and the matches."""
    matches = np.zeros((len(rows), len(others)), np.uint8)
    equal = np.empty(matches.shape, bool)
    alive = comp[rows][:, None] != comp[others][None, :]
    x, y = np.ascontiguousarray(values[rows, :upto].T), np.ascontiguousarray(values[others, :upto].T)
    for n in range(STEP, upto + 1, STEP):
        for k in range(n - STEP, n):
            np.equal(x[k][:, None], y[k][None, :], out=equal)
            matches += equal.view(np.uint8)
        alive &= matches >= least[n]
        if not alive.any():
            break
    return alive, matches


def _go_on(values: np.ndarray, i: np.ndarray, j: np.ndarray, done: int, least: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the pairs (i, j) that the values after the first ``done`` leave, and their matches in all."""
    at = np.arange(len(i))
    matches = (values[i, :done] == values[j, :done]).sum(axis=1)
    for n in range(done + STEP, HASHES + 1, STEP):
        matches = matches + (values[i[at], n - STEP:n] == values[j[at], n - STEP:n]).sum(axis=1)
        stay = matches >= least[n]
        at, matches = at[stay], matches[stay]
    return at, matches


def best_pairs(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """For each node the pair (a, b) with the most alike node of another class in one of its buckets, if the pruning leaves one.

    ``members`` has bucket, band, node and comp.
    """
    least = least_matches()

    def run(t: pa.Table) -> pa.Table:
        node, side, values = t.column("node").combine_chunks(), t.column("side").to_numpy(), _values(t, "minhash", np.uint8)
        comp = t.column("comp").combine_chunks().dictionary_encode().indices.to_numpy()
        low, high = t.column("low")[0].as_py(), t.column("high")[0].as_py()
        sides = [np.flatnonzero(side == k) for k in (low, high)]
        a, b, n = [], [], []
        for mine, theirs in ([sides] if low == high else [sides, sides[::-1]]):
            for k in range(0, len(mine), TILE):
                rows = mine[k:k + TILE]
                alive, matches = _alike(values, rows, theirs, comp, RANKED, least)
                some = np.flatnonzero(alive.any(axis=1))
                if len(some):
                    score = np.where(alive[some], matches[some] + 1, 0)
                    top = min(TOP, len(theirs))
                    near = np.argpartition(score, len(theirs) - top, axis=1)[:, len(theirs) - top:]
                    ok = np.take_along_axis(score, near, axis=1) > 0
                    i, j = np.repeat(rows[some], ok.sum(axis=1)), theirs[near[ok]]
                    at, m = _go_on(values, i, j, RANKED, least)
                    order = np.lexsort((-m, i[at]))
                    at, m = at[order], m[order]
                    lead = np.append(True, i[at][1:] != i[at][:-1])[:len(at)]
                    a.append(i[at][lead]), b.append(j[at][lead]), n.append(m[lead])
        a, b, n = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b, n))
        return pa.table({"a": node.take(pa.array(a)), "b": node.take(pa.array(b)), "n": pa.array(n, pa.int32())})

    rows = members.join(nodes.select("node", "minhash"), "node")
    met = _sides(rows, ["bucket", "band"], F.ceil(F.count(F.lit(1)) / SIDE))
    each = met.groupBy("bucket", "band", "low", "high").applyInArrow(run, "a binary, b binary, n int")
    best = each.groupBy("a").agg(F.max(F.struct("n", "b")).alias("best")).select("a", F.col("best.b").alias("b"))
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def open_pairs(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """All pairs (a, b) of different classes that share a bucket and that the pruning leaves, each once."""
    least = least_matches()

    def run(t: pa.Table) -> pa.Table:
        node, side, values, marks = t.column("node").combine_chunks(), t.column("side").to_numpy(), _values(t, "minhash", np.uint8), _values(t, "marks", "<u4")
        comp = t.column("comp").combine_chunks().dictionary_encode().indices.to_numpy()
        low, high, band = (t.column(c)[0].as_py() for c in ("low", "high", "band"))
        first, second = np.flatnonzero(side == low), np.flatnonzero(side == high)
        a, b = [], []
        for k in range(0, len(first), TILE):
            rows = first[k:k + TILE]
            alive, _ = _alike(values, rows, second, comp, STEP, least)
            if low == high:
                alive &= rows[:, None] < second[None, :]
            i, j = np.nonzero(alive)
            i, j = rows[i], second[j]
            at, _ = _go_on(values, i, j, STEP, least)
            i, j = i[at], j[at]
            lead = (marks[i] == marks[j]).argmax(axis=1) == band if len(i) else np.zeros(0, bool)
            a.append(i[lead]), b.append(j[lead])
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
        return pa.table({"a": node.take(pa.array(a)), "b": node.take(pa.array(b))})

    rows = members.join(nodes.select("node", "minhash", "marks"), "node")
    met = _sides(rows, ["bucket", "band"], F.ceil(F.count(F.lit(1)) / SIDE))
    return met.groupBy("bucket", "band", "low", "high").applyInArrow(run, "a binary, b binary")


def _near(shingles: np.ndarray, of: np.ndarray, first: np.ndarray, second: np.ndarray, threshold: float) -> np.ndarray:
    """Whether each row marked in ``first`` and each in ``second`` reach the threshold; ``of`` is the row of a shingle."""
    order = np.lexsort((of, shingles))
    shingles, of = shingles[order], of[order]
    new = np.ones(len(of), bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (of[1:] != of[:-1])
    shingles, of = shingles[new], of[new]
    size = np.bincount(of, minlength=len(first)).astype(float)
    common = np.zeros((int(first.sum()), int(second.sum())))
    if len(of):
        col = np.cumsum(np.append(False, shingles[1:] != shingles[:-1]))
        n, m, both = (np.bincount(col, side[of]) for side in (first, second, first & second))
        shared = (n > 0) & (m > 0) & (n + m - both > 1)
        of, col = of[shared[col]], (np.cumsum(shared) - 1)[col[shared[col]]]
        for c in range(0, int(shared.sum()), COLUMNS):
            i, j = np.searchsorted(col, [c, c + COLUMNS])
            x = np.zeros((len(first), min(COLUMNS, int(shared.sum()) - c)), np.float32)
            x[of[i:j], col[i:j] - c] = 1
            common += x[first] @ x[second].T
    return common >= threshold * (size[first][:, None] + size[second][None, :] - common)


def degrees(comp: DataFrame, texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """node and n_links, the number of other nodes of its class (node, comp) that reach the threshold."""

    def count(t: pa.Table) -> pa.Table:
        low, high, side = (t.column(c).to_numpy() for c in ("low", "high", "side"))
        first, second = side == low, side == high
        unpack = zstandard.ZstdDecompressor().decompress
        buf, off = byte_column(pa.array([unpack(x.as_py()) for x in t.column("packed")], pa.large_binary()))
        parts = []
        for i, j in pieces(off):
            own = lower(buf[off[i]:off[j]])
            s, e, row = word_spans(own, off[i:j + 1] - off[i])
            hashes, of = shingle_hashes(word_hashes(own, s, e), row, j - i, WIDTH)
            parts.append((hashes, of + i))
        near = _near(*(np.concatenate(x) for x in zip(*parts, strict=True)), first, second, threshold)
        n = np.zeros(len(side), np.int64)
        if low[0] == high[0]:
            n += near.sum(axis=1) - near.diagonal()
        else:
            n[first], n[second] = near.sum(axis=1), near.sum(axis=0)
        return pa.table({"node": t.column("node"), "n": pa.array(n)})

    rows = texts.join(comp.select("node", "comp"), "node")
    size = F.greatest(F.ceil(F.count(F.lit(1)) / CLASS_SIDE), F.ceil(F.sum("size") / SIDE_BYTES))
    met = _sides(rows, ["comp"], size).select("comp", "low", "high", "side", "node", "packed")
    return met.groupBy("comp", "low", "high").applyInArrow(count, "node binary, n long").groupBy("node").agg(F.sum("n").alias("n_links"))


def _classes(docs: DataFrame, text: str, key: str, rounds: int, tables: Tables) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Distinct texts (node, id, minhash, rows), rows (id, node), classes (node, comp) and the texts of nodes in a bucket."""
    sketched = tables.keep(sketch(docs.select(F.col(key).alias("id"), F.col(text).alias("text"))).select("id", "node", "minhash", "bands", "marks"), "sketch")
    one = [F.first(c).alias(c) for c in ("minhash", "bands", "marks")]
    nodes = tables.keep(sketched.where("node is not null").groupBy("node").agg(F.min("id").alias("id"), *one, F.count(F.lit(1)).alias("rows")), "nodes")
    rows = tables.keep(sketched.select("id", "node"), "rows")
    tables.drop(sketched)
    band = F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1)))
    banded = nodes.select("node", "bands", band.alias("band")).select("node", "band", F.xxhash64(F.expr("substring(bands, band * 8 + 1, 8)"), "band").alias("bucket"))
    crowded = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    members = tables.keep(banded.join(crowded, "bucket"), "members")
    wanted = members.select("node").distinct()
    packed = _packed(sketch(docs.select(F.col(text).alias("text")), values=False).where("node is not null"), "text")
    texts = tables.keep(packed.join(wanted, "node", "left_semi").dropDuplicates(["node"]), "texts")
    links = _verified(best_pairs(members.withColumn("comp", F.col("node")), nodes), texts, tables)
    for k in range(1, rounds):
        comp = components(links, tables)
        at = members.join(comp.select("node", "comp"), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        split = at.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi")
        open_ = tables.keep(at.join(split.select("bucket"), "bucket", "left_semi"), "open")
        pairs = best_pairs if k < rounds - 1 else open_pairs
        links = links.unionByName(_verified(pairs(open_, nodes), texts, tables))
        tables.drop(comp, open_)
    comp = components(links, tables)
    tables.drop(members)
    return nodes, rows, comp, texts


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", rounds: int = 4) -> DataFrame:
    """The key, class_id (the smallest key of its class), n_links (other texts that reach the threshold) and n_copies (rows with the same words) of each row."""
    tables = Tables()
    try:
        nodes, rows, comp, texts = _classes(docs, text, key, rounds, tables)
        degree = tables.keep(degrees(comp, texts), "degrees")
        tables.drop(texts)
        known = nodes.select("node", "id", "rows").join(comp.select("node", "comp"), "node", "left").join(degree, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        smallest = known.groupBy("comp").agg(F.min("id").alias("class_id"))
        table = known.join(smallest, "comp").select("node", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), (F.col("rows") - 1).alias("n_copies"))
        found = rows.select("id", "node").where("node is not null").join(table, "node").select("id", "class_id", "n_links", "n_copies")
        alone = rows.where("node is null").select("id", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(0).cast("long").alias("n_copies"))
        return settle(found.unionByName(alone).withColumnRenamed("id", key), "near-duplicates")[0]
    finally:
        tables.drop_all()


def representatives(docs: DataFrame, text: str = "text", key: str = "doc_id", rounds: int = 4) -> DataFrame:
    """One row of ``docs`` for each class of near duplicates, and all rows without a word.

    Of a class the row of the smallest key stays (null keys last, then the smaller digest of the words), of several such
    rows one.  Rows are told by key and words, so equal keys of different texts do no harm.
    """
    tables = Tables()
    try:
        nodes, _, comp, _ = _classes(docs, text, key, rounds, tables)
        known = nodes.select("node", "id").join(comp.select("node", "comp"), "node", "left")
        best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node"))
        stays = known.groupBy(F.coalesce("comp", "node").alias("comp")).agg(best.alias("best")).select(F.col("best.id").alias("id"), F.col("best.node").alias("node"))
        stays = tables.keep(stays, "stays")
        own, new = aside(docs, "node")
        id_, kept = new.get(key, key), [F.col(f"w.{new.get(c, c)}").alias(c) for c in docs.columns]
        whole = sketch(own, new.get(text, text), values=False)
        at = whole.alias("w").join(stays.alias("s"), (F.col("w.node") == F.col("s.node")) & F.col(f"w.{id_}").eqNullSafe(F.col("s.id")), "left_semi")
        one = at.dropDuplicates([id_, "node"]).alias("w").select(*kept)
        return settle(one.unionByName(whole.where("node is null").alias("w").select(*kept)), "representatives")[0]
    finally:
        tables.drop_all()
