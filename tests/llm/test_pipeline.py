"""The pipeline's stages against plain versions, and odd documents."""

import hashlib

import pytest

import corpus_pipeline as cp
from cinerank.llm import decontam, langid, pii
from cinerank.llm.common import fold, read
from test_jaccard import classes

SF = "/root/testdata/sf0.001"
S = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t)) for i, t, lang in rows], S)


def ids(df):
    return sorted((r["doc_id"] is None, r["doc_id"]) for r in df.select("doc_id").collect())


def words(k, n=30):
    return " ".join(f"word{k}x{i}" for i in range(n))


def test_stages_on_the_fixture(spark):
    """Each stage on what its predecessor kept, by plain rules on the driver."""
    docs = read(spark, SF, "documents")
    told = cp.language(spark, docs, SF).cache()
    labels = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs, langid.fit(docs.where(fold(4) != 2))).collect()}
    assert ids(told) == sorted((False, k) for k, v in labels.items() if v != "und")
    one = cp.near_duplicates(spark, told, SF).cache()
    rows = [(r["doc_id"], r["text"]) for r in told.collect()]
    assert ids(one) == sorted((False, c[0]) for c in classes(rows))
    clean = cp.decontaminate(spark, one, SF).cache()
    leaks = {r["doc_id"]: len(r["leaks"]) for r in decontam.find_leaks(one, read(spark, SF, "benchmark")).collect()}
    assert ids(clean) == sorted((False, k) for k, n in leaks.items() if not n)
    private = cp.personal_data(spark, clean, SF).cache()
    own = pii.Surrogates(cp.PII_KEY)
    old = {r["doc_id"]: r for r in clean.collect()}
    for r in private.collect():
        text, out, end = old[r["doc_id"]]["text"], [], 0
        for kind, i, j in pii.find(text):
            out += [text[end:i], own.make(kind, text[i:j])]
            end = j
        want = "".join([*out, text[end:]])
        assert r["text"] == want and (r["n_chars"] == len(want) if out else r["n_chars"] == old[r["doc_id"]]["n_chars"])
    assert all(df.columns == docs.columns for df in (told, one, clean, private))
    done = {r["doc_id"]: r for r in cp.encode(spark, private, SF).collect()}
    assert all(done[r["doc_id"]]["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest() for r in private.collect())
    whole = {tuple(r) for r in cp.run(spark, SF).collect()}
    assert whole == {tuple(r) for r in done.values()}


def test_no_labelled_language_loses_no_text(spark):
    docs = frame(spark, [(1, "a clean text", None), (2, "noch ein Text", None), (3, "12 34", None), (4, "", None), (5, None, None)])
    assert ids(cp.language(spark, docs, SF)) == [(False, 1), (False, 2)]


def test_rows_are_told_by_id_and_text(spark):
    """Equal ids of different texts, null ids, copies under null ids, texts without a word."""
    a, c, e = words(1), words(2), words(3)
    docs = frame(spark, [(3, a, "en"), (7, a, "en"), (7, c, "en"), (None, c, "en"), (None, e, "en"), (None, e + " ", "en"), (9, " ", "en"), (9, None, "en"), (9, None, "en"), (3, a, "en")])
    out = [(r["doc_id"], (r["text"] or "").strip() or None) for r in cp.near_duplicates(spark, docs, SF).collect()]
    assert sorted(out, key=repr) == sorted([(3, a), (7, c), (None, e), (9, None), (9, None), (9, None)], key=repr)


@pytest.mark.parametrize("k", range(4))
def test_empty_table_and_more_columns(spark, k):
    """No rows give no rows; columns called like a stage's own stay as they are."""
    name, stage = cp.STAGES[k]
    docs = frame(spark, [(1, words(5), "en"), (2, words(6), "de")])
    assert stage(spark, docs.limit(0), SF).count() == 0
    more = docs.selectExpr("*", "'x' AS node", "'y' AS lang_pred", "0.5D AS score", "1 AS id", "'z' AS `row`")
    out = stage(spark, more, SF)
    assert out.columns == more.columns
    assert {(r["node"], r["lang_pred"], r["score"], r["id"], r["row"]) for r in out.collect()} == {("x", "y", 0.5, 1, "z")}


def test_long_text(spark):
    text = " ".join(f"w{i % 5000}" for i in range(150_000))
    docs = frame(spark, [(1, text, "en"), (2, text + " end", "en")])
    assert ids(cp.near_duplicates(spark, docs, SF)) == [(False, 1)]
