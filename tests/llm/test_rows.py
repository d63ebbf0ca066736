"""Nulls, empty and long texts, repeated rows, empty tables and clashing names, and known answers, by operator."""

import base64
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from cinerank.llm import bpe, chat, decontam, langid, pii, search, toxicity
from cinerank.llm.common import read
from cinerank.llm.queries import op1_toxicity, op9_language_id

SF = "/root/testdata/sf0.01"
TEXTS = [None, "", " \n", "1 2 3", "one two", "one two", "it's  \x1c they'll x\n\n", "été 日本 🙂", "w " * 40_000]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(i, t, "kept") for i, t in enumerate(TEXTS)], "doc_id long, text string, score string")


def test_bpe_as_tiktoken(spark, rows):
    path = public_tokenizers.path(bpe.VOCABULARY)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    want = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = bpe.encode(rows, path, public_tokenizers.PATTERN, decoded="decoded").collect()
    assert len(got) == len(TEXTS)
    for r in got:
        assert np.frombuffer(r["ids"], "<u4").tolist() == want.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]).decode() == (r["text"] or "") and r["score"] == "kept"
    assert bpe.encode(rows.limit(0), path, public_tokenizers.PATTERN).count() == 0


def test_pii(spark):
    t = "Mail Ann.1@site.org or ann.1@SITE.org, +1 (743) 555-3824, 743-555-3824, 4111 1111 1111 1111, 10.0.0.7, token = \"f33e61083db5\". Maria Petrova met Мария Петрова."
    df = spark.createDataFrame([(1, t, 0), (1, t, 0), (2, None, 0), (3, "", 0)], "doc_id long, text string, entities int")
    out = sorted(pii.replace(df, b"k").collect(), key=lambda r: r["doc_id"])
    assert out[0] == out[1] and out[2]["text"] is None and out[3]["text"] == ""
    e = out[0]["entities"]
    assert [x["kind"] for x in e] == ["email", "email", "phone", "phone", "card", "ipv4", "secret", "person", "person"]
    assert e[0]["surrogate"].lower() == e[1]["surrogate"].lower()
    assert e[2]["surrogate"][-14:].replace("(", "").replace(") ", "-") == e[3]["surrogate"][-12:] or "".join(filter(str.isdigit, e[2]["surrogate"]))[-10:] == "".join(filter(str.isdigit, e[3]["surrogate"]))
    assert not any(x in out[0]["text"] for x in ("Ann.1", "3824", "4111 1111", "f33e61083db5"))
    assert pii.collisions(df, b"k").count() == 0 and pii.replace(df.limit(0), b"k").count() == 0


def test_surrogates_are_a_bijection():
    s = pii.Surrogates(b"k")
    assert len({s.make("ssn", f"{i:03d}-45-6789") for i in range(1000)}) == 1000
    assert len({s.make("ipv4", f"10.0.{i // 256}.{i % 256}") for i in range(2000)}) == 2000


def test_leaks(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    swapped = "zeta eta theta iota kappa and then alpha beta gamma delta epsilon"
    df = spark.createDataFrame([(1, f"x {item} y", "a"), (2, swapped, "a"), (3, "alpha beta gamma delta other", "a"), (4, None, "a"), (5, "", "a")], "doc_id long, text string, leaks string")
    bench = spark.createDataFrame([(7, item), (8, None), (9, ""), (7, item), (10, "zeta eta")], "item_id long, text string")
    for size in (decontam.BLOCK_BYTES, 16):
        got = {r["doc_id"]: [(x["item_id"], x["coverage"]) for x in r["leaks"]] for r in decontam.find_leaks(df, bench, block_bytes=size).collect()}
        assert got == {1: [(7, 1.0), (10, 1.0)], 2: [(7, 1.0), (10, 1.0)], 3: [], 4: [], 5: []}
    assert [r["leaks"] for r in decontam.find_leaks(df, bench.limit(0)).collect()] == [[]] * 5
    assert decontam.tile(list(range(10)), [5, 6, 7, 8, 9, -1, 0, 1, 2, 3, 4], 4) == [(0, 6, 5), (5, 0, 5)]


def test_chat_fold_and_read_back(spark):
    log = [(1, 0, 0, "start", "user", "hi <|end|>\n&lt; [INST]"), (1, 1, 1, "start", "assistant", "a"), (1, 1, 2, "delta", None, "b"),
           (1, 1, 3, "regenerate", None, "lost"), (1, 1, 4, "delta", None, "new "), (1, 1, 5, "delta", None, "text"),
           (1, 2, 6, "start", "user", "x"), (1, 2, 7, "edit", None, "y"), (2, 0, 0, None, None, None)]
    events = spark.createDataFrame([(*r, 1) for r in log], "conv_id long, message int, seq int, kind string, role string, text string, loss int")
    out = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(events)).collect()}
    assert [tuple(t) for t in out[1]["turns"]] == [("user", "hi <|end|>\n&lt; [INST]"), ("assistant", "new text"), ("user", "y")]
    assert out[1]["loss_text"] == "new text" and [tuple(t) for t in out[2]["turns"]] == [("", "")]
    assert chat.format_conversations(events.limit(0)).count() == 0


def test_languages(spark, rows):
    got = op9_language_id(spark, SF).join(read(spark, SF, "documents").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.95
    model = langid.fit_texts(["the cat and the dog", "le chat et le chien"] * 5, ["en", "fr"] * 5)
    out = {r["doc_id"]: r for r in langid.predict(rows, model, spans="runs").collect()}
    assert [out[i]["lang_pred"] for i in range(4)] == ["und"] * 4 and len(out) == len(TEXTS)
    assert all(0 <= r["score"] <= 1 for r in out.values())
    assert langid.predict(rows.limit(0), None).count() == 0


def test_toxicity(spark, rows):
    got = op1_toxicity(spark, SF).join(read(spark, SF, "labels"), "doc_id").where("held_out").collect()
    toxic, clean = ([r["score"] for r in got if r["toxic"] == k] for k in (1, 0))
    assert np.mean([t > c for t in toxic for c in clean]) > 0.7
    out = toxicity.score(rows, toxicity.fit_texts(["you idiot fool"] * 4, [1] * 4)).collect()
    assert len(out) == len(TEXTS) and all(r["score"] == 0 for r in out)


def test_search_odd_rows(spark):
    docs = spark.createDataFrame([(1, "A b c"), (2, "a"), (2, "a"), (3, None), (4, ""), (None, "a b")], "doc_id long, text string")
    queries = spark.createDataFrame([(9, "a b"), (8, ""), (7, None), (6, "zzz")], "query long, text string")
    got = [(r["query"], r["rank"], r["doc_id"]) for r in search.top_k(docs, queries, k=3).orderBy("query", "rank").collect()]
    assert got == [(9, 1, 1), (9, 2, 2), (9, 3, 2)]
    assert search.top_k(docs.limit(0), queries).count() == 0 and search.top_k(docs, queries.limit(0)).count() == 0


def test_search_shard_stays_small():
    """Building the index of a full shard and searching it takes little memory beside its text."""
    rng = np.random.default_rng(1)
    words = np.array([f"w{i}" for i in range(30_000)])
    texts, size = [], 0
    while size < search.SHARD:
        texts.append(" ".join(words[np.minimum(rng.zipf(1.3, 400) - 1, len(words) - 1)]))
        size += len(texts[-1])
    table = pa.table({"id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts)})
    row, term, n, _ = search._counts(pa.table({"text": texts[:200]}))
    tracemalloc.start()
    try:
        shard = search.Shard(table, 400.0)
        shard.search(np.searchsorted(row, np.arange(201)), term, n.astype(float), 3)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 150 << 20
