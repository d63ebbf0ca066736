"""Language of each word, and so of each text, by a linear-chain conditional random field.

A chain is a stretch of up to ``CHAIN`` consecutive words of a text (a longer text is several chains, none left out);
its words' labels are languages.  A word's features are its byte n-grams with marked ends (so affixes too), its prefix
and suffix, its membership in each language's lexicon of common words, and itself.  Feature weights and label
transitions are learnt together by the likelihood of labelled chains, some of them spliced from two languages;
forward-backward gives each word's label probabilities.  A text's language is the label of the largest mean
probability over its words, and that mean is its score.

Fitting uses at most ``per_language`` labelled rows of each language (those of smallest hash), on the driver;
prediction is one pass over whole texts without a shuffle.  Null texts and texts without a letter are ``und`` with
score 0, as is everything if nothing was learnt.  Ties go to the label that sorts first.  Rows are kept one for one.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.llm.common import aside, byte_column, coefficients, fold, mix, pieces, widened, word_hashes, word_spans

CHAIN, BITS, LEXICON, EPOCHS, BATCH = 64, 16, 300, 2, 256
#: Labelled rows of each language that fitting may use, and the words taken from them at most.
PER_LANGUAGE, WORDS = 250, 60_000
_LETTER = re.compile(r"[^\W\d_]").search
_LETTERS = np.zeros(256, bool)
_LETTERS[97:123] = _LETTERS[128:] = True


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # of hashed features, by label
    lexicons: list[np.ndarray]  # sorted word hashes of each label
    lexicon_weights: np.ndarray
    transitions: np.ndarray


def text_words(texts: list[str | None]):
    """Lower-case bytes, and start, end, row and hash of their words with a letter."""
    buf, off = byte_column(pa.array([(t or "").lower() for t in texts], pa.large_string()))
    starts, ends, row = word_spans(buf, off)
    letters = np.concatenate([[0], np.cumsum(_LETTERS[buf])])
    keep = letters[ends] > letters[starts]
    starts, ends, row = starts[keep], ends[keep], row[keep]
    return buf, starts, ends, row, word_hashes(buf, starts, ends)


def word_features(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of each word, and the word each belongs to, in order of words."""
    lens = ends - starts + 2
    first = np.cumsum(lens) - lens
    total = int(lens.sum())
    at = np.arange(total) - np.repeat(first, lens)
    marked = np.full(total, 94, np.uint64)  # ^ before and $ after the word
    inner = (at > 0) & (at < np.repeat(lens, lens) - 1)
    marked[inner] = buf[(np.repeat(starts, lens) + at - 1)[inner]]
    marked[first + lens - 1] = 36
    word = np.repeat(np.arange(len(starts)), lens)
    left = np.repeat(lens, lens) - at
    c = coefficients(6, 5)
    feats, of = [], []
    with np.errstate(over="ignore"):
        h = np.zeros(total, np.uint64)
        for n in range(1, 5):
            h = h[:total - n + 1] + (marked[n - 1:] + np.uint64(1)) * c[n - 1] if total >= n else h[:0]
            ok = left[:len(h)] >= n
            if n > 1:
                feats.append(mix(h[ok] + np.uint64(n)) >> np.uint64(64 - BITS))
                of.append(word[:len(h)][ok])
    feats.append((word_hashes(buf, starts, ends) * c[5]) >> np.uint64(64 - BITS))
    of.append(np.arange(len(starts)))
    feats, of = np.concatenate(feats).astype(np.int64), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return feats[order], of[order]


def _emissions(model: Model, buf, starts, ends, hashes):
    """Scores of each word by label; also its features, for the gradient."""
    f, of = word_features(buf, starts, ends)
    n = np.bincount(of, minlength=len(starts))
    sums = np.add.reduceat(model.weights[f], np.cumsum(n) - n, axis=0) if len(f) else np.zeros((0, len(model.labels)))
    lex = np.column_stack([np.isin(hashes, x) for x in model.lexicons]).astype(np.float64)
    return sums / np.sqrt(n)[:, None] + lex @ model.lexicon_weights, (f, of, n, lex)


def _marginals(scores: np.ndarray, lens: np.ndarray, transitions: np.ndarray, pairs: bool = False):
    """Label probabilities of each place of chains sorted by falling length (chain, place, label), and expected transitions."""
    n, steps, k = scores.shape
    e = np.exp(scores - scores.max(axis=2, keepdims=True))
    t = np.exp(transitions)
    alpha, beta = np.zeros_like(e), np.ones_like(e)
    live = [int(np.searchsorted(-lens, -s, side="left")) for s in range(steps)]  # chains longer than s
    alpha[:, 0] = e[:, 0] / e[:, 0].sum(axis=1, keepdims=True)
    for s in range(1, steps):
        m = live[s]
        a = (alpha[:m, s - 1] @ t) * e[:m, s]
        alpha[:m, s] = a / a.sum(axis=1, keepdims=True)
    for s in range(steps - 2, -1, -1):
        m = live[s + 1]
        b = (beta[:m, s + 1] * e[:m, s + 1]) @ t.T
        beta[:m, s] = b / b.sum(axis=1, keepdims=True)
    p = alpha * beta
    p /= np.maximum(p.sum(axis=2, keepdims=True), 1e-300)
    if not pairs:
        return p, None
    expected = np.zeros((k, k))
    for s in range(1, steps):
        m = live[s]
        x = alpha[:m, s - 1, :, None] * t * (beta[:m, s] * e[:m, s])[:, None, :]
        expected += (x / x.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    return p, expected


def _chains(row: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and number of words of each chain."""
    if not len(row):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    place = np.arange(len(row)) - np.repeat(edge, np.diff(np.append(edge, len(row))))
    first = np.flatnonzero(place % size == 0)
    return first, np.diff(np.append(first, len(row)))


def fit_texts(texts: list[str], langs: list[str], seed: int = 7) -> Model | None:
    labels = sorted(set(langs))
    if not labels:
        return None
    rng = np.random.default_rng(seed)
    k = len(labels)
    buf, starts, ends, row, hashes = text_words(texts)
    of_row = np.array([labels.index(x) for x in langs], np.int64)
    y = of_row[row] if len(row) else row
    # equally many words of each language at most
    keep = np.zeros(len(row), bool)
    for j in range(k):
        keep[np.flatnonzero(y == j)[:WORDS]] = True
    starts, ends, row, hashes, y = starts[keep], ends[keep], row[keep], hashes[keep], y[keep]
    lexicons = []
    for j in range(k):
        h, n = np.unique(hashes[y == j], return_counts=True)
        lexicons.append(np.sort(h[np.lexsort((h, -n))][:LEXICON]))
    model = Model(labels, np.zeros((1 << BITS, k)), lexicons, np.zeros((k, k)), np.zeros((k, k)))
    first, lens = _chains(row, 24)
    if not len(first):
        return model
    g2 = [np.full_like(x, 1e-2) for x in (model.weights, model.lexicon_weights, model.transitions)]
    for _ in range(EPOCHS):
        order = rng.permutation(len(first))
        for at in range(0, len(order), BATCH):
            ids = order[at:at + BATCH]
            words = [np.arange(first[i], first[i] + lens[i]) for i in ids]
            # a third are spliced from two chains, as code-switched text is
            for q in range(0, len(words) - 1, 3):
                a, b = words[q], words[q + 1]
                words[q] = np.concatenate([a[:max(1, len(a) // 2)], b[len(b) // 2:]])
            words.sort(key=len, reverse=True)
            n = np.array([len(w) for w in words])
            flat = np.concatenate(words)
            chain = np.repeat(np.arange(len(words)), n)
            place = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
            _, some, back = np.unique(hashes[flat], return_index=True, return_inverse=True)
            u = flat[some]
            e, (f, of, nf, lex) = _emissions(model, buf, starts[u], ends[u], hashes[u])
            scores = np.zeros((len(words), n.max(), k))
            scores[chain, place] = e[back]
            p, expected = _marginals(scores, n, model.transitions, pairs=True)
            err = -p[chain, place]
            err[np.arange(len(flat)), y[flat]] += 1
            by_word = np.stack([np.bincount(back, err[:, j], len(u)) for j in range(k)], axis=1)
            same = chain[1:] == chain[:-1]
            seen = np.bincount(y[flat][:-1][same] * k + y[flat][1:][same], minlength=k * k).reshape(k, k)
            scaled = (by_word / np.sqrt(nf)[:, None])[of]
            grads = (np.stack([np.bincount(f, scaled[:, j], 1 << BITS) for j in range(k)], axis=1), lex.T @ by_word, seen - expected)
            for x, g, s in zip((model.weights, model.lexicon_weights, model.transitions), grads, g2, strict=True):
                s += g * g
                x += 0.3 * g / np.sqrt(s)
    model.transitions = np.clip(model.transitions, -4, 4)
    return model


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """A model from the text and lang of the rows given; null texts and languages are left out, copies count once."""
    rows = docs.select("text", "lang", F.xxhash64("text").alias("h")).where("text is not null and lang is not null")
    langs = sorted(r[0] for r in rows.select("lang").distinct().collect())
    if not langs:
        return None
    pick = lambda x: rows.where(F.col("lang") == x).select("lang", "h").distinct().orderBy("h").limit(per_language)
    sample = reduce(DataFrame.unionByName, map(pick, langs))
    # at most per_language rows of two small values for each language
    got = rows.join(F.broadcast(sample), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text")).toArrow().to_pylist()
    got.sort(key=lambda r: (r["lang"], r["h"]))
    return fit_texts([r["text"] for r in got], [r["lang"] for r in got])


def label_texts(model: Model, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean label probabilities of each text, and the row and best label of each word."""
    k = len(model.labels)
    buf, starts, ends, row, hashes = text_words(texts)
    if not len(row):
        return np.zeros((len(texts), k)), row, row
    _, some, back = np.unique(hashes, return_index=True, return_inverse=True)
    e, _ = _emissions(model, buf, starts[some], ends[some], hashes[some])
    first, lens = _chains(row, CHAIN)
    order = np.argsort(-lens, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    chain = np.repeat(rank, lens)
    place = np.arange(len(row)) - np.repeat(first, lens)
    scores = np.zeros((len(first), lens.max(), k))
    scores[chain, place] = e[back]
    p, _ = _marginals(scores, lens[order], model.transitions)
    p = p[chain, place]
    sums = np.stack([np.bincount(row, p[:, j], len(texts)) for j in range(k)], axis=1)
    return sums / np.maximum(1, np.bincount(row, minlength=len(texts)))[:, None], row, p.argmax(axis=1)


def predict(df: DataFrame, model: Model | None, text: str = "text", spans: str | None = None) -> DataFrame:
    """``df`` with ``lang_pred`` and ``score``; with ``spans`` also runs of words of one label: first word, words, lang."""
    kept = df.drop(*(x for x in ("lang_pred", "score", spans) if x))
    names = ["lang_pred", "score"] + ([spans] if spans else [])
    kinds = ("string", "double", "array<struct<first:int,words:int,lang:string>>")
    schema = widened(kept, *zip(names, kinds))
    kind = pa.list_(pa.struct([("first", pa.int32()), ("words", pa.int32()), ("lang", pa.string())]))

    def run(batches):
        for b in batches:
            for i, j in pieces(byte_column(b.column(text))[1]):
                part = b.slice(i, j - i)
                texts = part.column(text).to_pylist()
                written = np.array([t is not None and _LETTER(t) is not None for t in texts]) & (model is not None)
                if model is None:
                    cols = [pa.array(["und"] * len(texts)), pa.array([0.0] * len(texts))]
                    row = best = np.zeros(0, np.int64)
                else:
                    p, row, best = label_texts(model, texts)
                    top = p.argmax(axis=1)
                    pred = [model.labels[x] if w else "und" for x, w in zip(top, written, strict=True)]
                    cols = [pa.array(pred, pa.string()), pa.array(np.where(written, np.minimum(1, p[np.arange(len(p)), top]), 0.0))]
                if spans:
                    out = [[] for _ in texts]
                    cut = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (best[1:] != best[:-1]))) if len(row) else row
                    start = np.searchsorted(row, row[cut]) if len(row) else row
                    for c, e, s in zip(cut, np.append(cut[1:], len(row)), start, strict=False):
                        out[row[c]].append({"first": int(c - s), "words": int(e - c), "lang": model.labels[best[c]]})
                    cols.append(pa.array(out, kind))
                yield pa.RecordBatch.from_arrays([*part.columns, *cols], names=[*part.schema.names, *names])

    return kept.mapInArrow(run, schema)


def tellable(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The rows of ``df`` whose language the model tells, as they are.

    Without a model (no labelled row to learn from) nothing can be told, and every text with a letter stays.
    """
    if model is None:
        return df.where(F.col(text).rlike(r"\p{L}"))
    own, new = aside(df, "lang_pred", "score")
    told = predict(own, model, new.get(text, text)).where("lang_pred <> 'und'")
    return told.select(*(F.col(new.get(c, c)).alias(c) for c in df.columns))


def held_out_languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row, learnt from rows outside of the held-out fold."""
    model = fit(docs.where(fold(4) != 2))
    out = predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score")
