"""Forward-backward against enumeration, texts without a language, long texts and clashing columns."""

import itertools

import numpy as np
import pytest

from cinerank.llm import langid


@pytest.mark.parametrize("labels", [1, 2, 4])
def test_marginals_against_enumeration(labels):
    """Chains of falling length: each word's label probabilities and the expected transitions, summed over all labellings."""
    rng = np.random.default_rng(labels)
    lens = np.array([5, 4, 2, 1])
    scores, transitions = rng.normal(size=(4, 5, labels)), rng.normal(size=(labels, labels))
    p, expected = langid._marginals(scores, lens, transitions, True)
    want_pairs = np.zeros((labels, labels))
    for c, n in enumerate(lens):
        want, total, pairs = np.zeros((n, labels)), 0.0, np.zeros((labels, labels))
        for path in itertools.product(range(labels), repeat=int(n)):
            w = np.exp(sum(scores[c, s, y] for s, y in enumerate(path)) + sum(transitions[a, b] for a, b in itertools.pairwise(path)))
            total += w
            for s, y in enumerate(path):
                want[s, y] += w
            for a, b in itertools.pairwise(path):
                pairs[a, b] += w
        assert p[c, :n] == pytest.approx(want / total)
        want_pairs += pairs / total
    assert expected == pytest.approx(want_pairs)


def test_tellable_keeps_rows_as_they_are(spark):
    rows = [("ein Text und noch ein Text", "x"), ("1 2 3", "x"), (None, "x"), ("", "x"), ("ein Text und noch ein Text", "x"), ("word " * 60_000, "x")]
    df = spark.createDataFrame(rows, "text string, lang_pred string")
    model = langid.fit_texts(["ein Text und das ist gut", "the text and this is good"] * 20, ["de", "en"] * 20)
    for m in (model, None):
        out = langid.tellable(df, m)
        assert out.columns == ["text", "lang_pred"]
        assert sorted(len(r["text"]) for r in out.collect()) == [26, 26, 300_000] and {r["lang_pred"] for r in out.collect()} == {"x"}
    assert langid.tellable(df.limit(0), model).count() == 0
