"""Broad and narrow toxic vocabularies, few labels, one label, odd texts, the gain of a window."""

import random

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from cinerank.llm import toxicity
from cinerank.llm.common import byte_column

SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()


def made_up(n, vocabulary, seed=5):
    """Texts of invented words; each toxic one has three words of the toxic vocabulary."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))
    toxic = ["".join(rng.choice("bcdfgklmpruvwxyz") + rng.choice("aeiou") for _ in range(3)) for _ in range(vocabulary)]
    out = []
    for y in (0, 1):
        for _ in range(n):
            words = [word() for _ in range(rng.randint(40, 300))]
            for _ in range(3 * y):
                words[rng.randrange(len(words))] = rng.choice(toxic)
            out.append((" ".join(words), y))
    rng.shuffle(out)
    return [t for t, _ in out], np.array([y for _, y in out])


def scores(model, texts):
    return model.scorer().scores(*byte_column(pa.array(texts, pa.string())))


@pytest.mark.parametrize("vocabulary,recall,alarms", [(20, 0.9, 0.1), (60, 0.9, 0.1), (100, 0.85, 0.12), (200, 0.75, 0.2), (400, 0.65, 0.35)])
def test_recall_by_vocabulary(vocabulary, recall, alarms):
    texts, y = made_up(1600, vocabulary)
    model = toxicity.fit_texts(texts[:2000], y[:2000].tolist())
    p, z = scores(model, texts[2000:]) >= 0.5, y[2000:]
    print(vocabulary, p[z == 1].mean(), p[z == 0].mean())
    assert p[z == 1].mean() >= recall and p[z == 0].mean() <= alarms


def test_order_of_the_labels_is_no_matter():
    texts, y = made_up(300, 20)
    order = np.argsort(y, kind="stable")
    paired = np.ravel([order[:300], order[300:]], order="F")  # labels in turn
    for o in (order, paired):
        p = scores(toxicity.fit_texts([texts[i] for i in o], y[o].tolist()), texts)
        assert (p[y == 1] >= 0.5).mean() > (p[y == 0] >= 0.5).mean() + 0.3


def test_few_and_single_labels():
    one = toxicity.fit_texts(["a b"] * 3, [0] * 3)
    assert scores(one, ["a b", "", None]).tolist() == [0, 0, 0]
    few = toxicity.fit_texts(["you idiot fool", "an idiot here", "what an idiot"] + ["a fine day", "good words here", "nice"], [1] * 3 + [0] * 3)
    assert few.toxic and ((0 <= scores(few, ["idiot", "", None])) & (scores(few, ["x", "y", "z"]) <= 1)).all()


def test_gains_against_plain_compression():
    """The features are those of each window compressed by itself under either dictionary."""
    texts, y = made_up(200, 10)
    model = toxicity.fit_texts(texts, y.tolist())
    pair = [zstandard.ZstdCompressor(level=toxicity.LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for d in (model.ordinary, model.toxic)]
    for t in [*texts[:20], "one two", "", "A  B\n\nc " * 9]:
        data, words = t.lower().encode(), []
        for m in toxicity_words(data):
            words.append(m)
        gains = []
        for k in range(0, len(words), toxicity.WINDOW):
            a, b = words[k][0], words[min(k + toxicity.WINDOW, len(words)) - 1][1]
            window = data[max(0, a - 1):b]
            gains.append(len(pair[0].compress(window)) - len(pair[1].compress(window)))
        top = sorted((max(0, g) for g in gains), reverse=True) + [0, 0]
        want = [top[0], top[1] if len(gains) > 1 else 0, np.log1p(sum(max(0, g - 2) for g in gains))]
        got = model.scorer().features(*byte_column(pa.array([t], pa.string())))[0]
        assert got == pytest.approx(want)


def toxicity_words(data):
    import re

    return [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", data)]


def test_rows_and_columns(spark):
    """Repeated and null rows stay, a column named like the score is replaced, no rows give no rows; long texts."""
    model = toxicity.fit_texts(*(lambda t, y: (t, y.tolist()))(*made_up(150, 8)))
    rows = [(1, "a b", 7.0), (1, "a b", 7.0), (2, None, 7.0), (3, "word " * 100_000, 7.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double")
    out = toxicity.score(df, model).collect()
    assert len(out) == 4 and all(0 <= r["score"] <= 1 for r in out) and out[0]["score"] == out[1]["score"]
    assert toxicity.score(df.limit(0), model).count() == 0


def test_clashing_labels(spark):
    """A row labelled both ways counts on both sides; unlabelled rows and null labels are left out."""
    docs = spark.createDataFrame([(i, "good words" if i % 2 else "bad idiot words") for i in range(80)] + [(99, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(80)] + [(3, 1), (3, 1), (5, None), (99, 1), (1234, 0)], "doc_id long, toxic int")
    assert toxicity.fit(docs, labels).toxic
