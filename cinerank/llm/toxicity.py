"""Toxicity by compression distance: windows of words under two zstandard dictionaries.

Both dictionaries open with the same background, cut from ordinary documents.  The ordinary one goes on with more of
it, the toxic one with the stretches of toxic documents that set them apart (runs of character n-grams whose document
frequency among toxic documents lies far above that among ordinary ones).  A window that the toxic dictionary
compresses to fewer bytes than the ordinary one speaks for toxicity; a logistic calibration on labelled documents
that took no part in the dictionaries maps a document's gains to a probability.  ``GATES`` are tried from strong evidence
in little space to weak evidence in more, for a broad toxic vocabulary has rare words only; a weaker one is taken if its
loss on the calibration documents is clearly less.  Where nothing stands out, both dictionaries are texts of their side.

Fitting uses at most ``per_class`` labelled documents of each label (those of smallest hash), on the driver; scoring
is one pass over whole texts without a shuffle.  Null and empty texts have no windows and get the score of no gain.
With no labelled document of either kind every score is 0.  Rows are kept one for one.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.llm.common import byte_column, fold, lower, pieces, widened, word_spans

#: Words in a window, bytes in an n-gram, bytes of background and of distinctive text in a dictionary, level of zstandard.
WINDOW, GRAM, BACKGROUND, DISTINCT, LEVEL = 8, 5, 7680, 512, 7
#: Standard errors of evidence, least documents, and bytes of a dictionary that such n-grams may fill.
GATES = ((3, 4, DISTINCT), (2, 4, 8192), (1.5, 3, 8192), (1, 3, 8192), (0.5, 2, 8192))
#: Labelled documents of each label that fitting may use, half for the dictionaries and half for the calibration.
PER_CLASS = 3000


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    weights: list[float] = field(default_factory=lambda: [0.0])
    window: int = WINDOW

    def scorer(self):
        return _Scorer(self)


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=d, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)


class _Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.pair = [_compressor(model.ordinary), _compressor(model.toxic)] if model.toxic else []

    def features(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        """A row for each document: its largest gain, its second largest, and the logarithm of its gains over 2, summed."""
        out = np.zeros((len(off) - 1, 3))
        buf = lower(buf)
        starts, ends, row = word_spans(buf, off)
        if not self.pair or not len(starts):
            return out
        n = np.bincount(row, minlength=len(out))
        place = np.arange(len(starts)) - np.repeat(np.cumsum(n) - n, n)
        first = np.flatnonzero(place % self.model.window == 0)
        last = np.append(first[1:], len(starts)) - 1
        of = row[first]
        spans = np.empty((len(first), 2), np.uint64)
        spans[:, 0] = np.where(starts[first] > off[of], starts[first] - 1, starts[first])
        spans[:, 1] = ends[last].astype(np.uint64) - spans[:, 0]
        data = zstandard.BufferWithSegments(buf.tobytes(), spans.tobytes())
        a, b = (np.fromiter(map(len, c.multi_compress_to_buffer(data)), np.int64, len(spans)) for c in self.pair)
        gain = (a - b).astype(float)
        order = np.lexsort((-gain, of))
        g, o = gain[order], of[order]
        head = np.flatnonzero(np.append(True, o[1:] != o[:-1]))
        out[o[head], 0] = g[head]
        two = head[(head + 1 < len(o)) & (o[np.minimum(head + 1, len(o) - 1)] == o[head])]
        out[o[two], 1] = np.maximum(0, g[two + 1])
        out[:, 2] = np.log1p(np.bincount(of, np.maximum(0, gain - 2), minlength=len(out)))
        out[:, 0] = np.maximum(0, out[:, 0])
        return out

    def scores(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        w = np.array(self.model.weights)
        if not self.pair:
            return np.zeros(len(off) - 1)
        return 1 / (1 + np.exp(-(w[0] + self.features(buf, off) @ w[1:])))


def _plain(text: str | None) -> bytes:
    return b" " + b" ".join(lower(np.frombuffer((text or "").encode(), np.uint8)).tobytes().split())


def _grams(text: bytes) -> set[bytes]:
    return {text[i:i + GRAM] for i in range(len(text) - GRAM + 1)}


def _contrasts(toxic: list[bytes], ordinary: list[bytes], gates) -> list[set[bytes]]:
    """For each gate (standard errors, least, space) the n-grams in ``least`` toxic documents or more whose log odds ratio
    of document frequencies exceeds 1 by so many standard errors."""
    a, b = Counter(), Counter()
    for t in toxic:
        a.update(_grams(t))
    for t in ordinary:
        b.update(_grams(t))
    grams = [g for g, n in a.items() if n >= min(least for _, least, _ in gates)]
    n = np.array([a[g] for g in grams], float)
    x, y = n + 0.5, np.array([b[g] for g in grams], float) + 0.5
    odds, error = np.log(x / (len(toxic) + 1 - x)) - np.log(y / (len(ordinary) + 1 - y)), np.sqrt(1 / x + 1 / y)
    return [{grams[i] for i in np.flatnonzero((odds - errors * error > 1) & (n >= least))} for errors, least, _ in gates]


def _distinct(toxic: list[bytes], grams: set[bytes], space: int = DISTINCT, least: int = 3) -> bytes:
    """The commonest runs of distinctive n-grams, the commonest last, where matches cost least."""
    runs: Counter = Counter()
    for t in toxic:
        own, k, n = set(), 0, len(t) - GRAM + 1
        hits = [t[i:i + GRAM] in grams for i in range(n)]
        while k < n:
            if hits[k]:
                j = k
                while j + 1 < n and hits[j + 1]:
                    j += 1
                own.add(t[k:j + GRAM])
                k = j + GRAM
            else:
                k += 1
        runs.update(own)
    picked, size = [], 0
    for run, n in sorted(runs.items(), key=lambda x: (-x[1], x[0])):
        if n < least or size + len(run) > space:
            break
        if not any(run in p for p in picked):
            picked.append(run)
            size += len(run)
    return b"".join(reversed(picked))


def _logistic(x: np.ndarray, y: np.ndarray) -> list[float]:
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 0.01 * np.eye(len(w)), x.T @ (y - p) - 0.01 * w)
        w += np.clip(step, -3, 3)
        if abs(step).max() < 1e-6:
            break
    return w.tolist()


def fit_texts(texts: list[str | None], labels: list[int]) -> Model:
    """A model from labelled texts: of each label every other one makes the dictionaries, the rest the calibration (all of them if few)."""
    plain = [_plain(t) for t in texts]
    few = min(sum(labels), len(labels) - sum(labels)) < 60
    place = Counter()
    for_dictionary = []
    for y in labels:
        for_dictionary.append(few or place[y] % 2 == 0)
        place[y] += 1
    toxic = [t for t, y, d in zip(plain, labels, for_dictionary, strict=True) if y and d]
    ordinary = [t for t, y, d in zip(plain, labels, for_dictionary, strict=True) if not y and d]
    if not toxic or not ordinary:
        return Model(b"", b"")
    share = max(64, 2 * BACKGROUND // len(ordinary))
    background = b"".join(t[:share] for t in ordinary)[:BACKGROUND]
    models = []
    for grams, (_, least, space) in zip(_contrasts(toxic, ordinary, GATES), GATES, strict=True):
        distinct = _distinct(toxic, grams, space, min(3, least))
        if distinct:
            fill = background * (len(distinct) // max(1, len(background)) + 1)
            models.append(Model(background + fill[:len(distinct)], background + distinct))
    if not models:  # nothing stands out: whole texts of each side
        models.append(Model(*((b"".join(side) or b" ")[:BACKGROUND] for side in (ordinary, toxic))))
    rest = [i for i, d in enumerate(for_dictionary) if few or not d]
    col = pa.array([texts[i] or "" for i in rest], pa.string())
    buf, off = byte_column(col)
    y = np.array([labels[i] for i in rest], float)
    best = None
    for model in models:
        x = np.vstack([model.scorer().features(buf[off[i]:off[j]], off[i:j + 1] - off[i]) for i, j in pieces(off)])
        model.weights = _logistic(x, y)
        z = np.clip(model.weights[0] + x @ np.array(model.weights[1:]), -30, 30)
        loss = float(np.log1p(np.exp(-np.where(y == 1, z, -z))).mean())
        if best is None or loss < 0.9 * best[0]:  # weaker evidence must be clearly better
            best = (loss, model)
    return best[1]


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """A model from the labelled rows given (doc_id, toxic); null labels and texts are left out."""
    pick = lambda y: labels.where(F.col("toxic") == y).select("doc_id", "toxic").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
    sample = pick(0).unionByName(pick(1))
    rows = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(sample), "doc_id")  # at most 2 * per_class rows of two numbers
    got = rows.select("doc_id", "toxic", "text").toArrow().to_pylist()
    got.sort(key=lambda r: (hash((r["doc_id"] * 2654435761) % (1 << 32)), r["doc_id"], r["toxic"], r["text"]))
    by = [[r for r in got if r["toxic"] == y] for y in (0, 1)]
    order = [r for rows in by for r in rows]
    return fit_texts([r["text"] for r in order], [r["toxic"] for r in order])


def score(df: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with the probability of toxicity of its texts."""
    kept = df.drop(out)

    def run(batches):
        scorer = model.scorer()
        for b in batches:
            buf, off = byte_column(b.column(text))
            got = [scorer.scores(buf[off[i]:off[j]], off[i:j + 1] - off[i]) for i, j in pieces(off)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.concatenate(got) if got else [], pa.float64())], names=[*b.schema.names, out])

    return kept.mapInArrow(run, widened(kept, (out, "double")))


def held_out_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row, learnt from labelled rows outside of the held-out fold."""
    model = fit(docs, labels.where(fold(5) != 0))
    out = score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
