"""Quality rules, fill-in-the-middle and periodic runs against plain versions over odd and random texts."""

import hashlib
import random
import re
from collections import Counter
from fractions import Fraction

import pytest

from cinerank.llm import fim, quality, runs
from cinerank.llm.common import fold_of, read
from cinerank.llm.queries import _planted, op13_periodic_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def made_up(seed, n):
    """Texts of few different words, so that runs, repeated windows and equal lines come about."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        words = rng.choices(["a", "b", "The", "été", "日本", "x*", "THE", "und", "c"][:rng.randint(1, 9)], k=rng.randint(0, 90))
        if rng.random() < 0.7 and words:
            i, p = rng.randrange(len(words)), rng.randint(1, 9)
            words[i:i] = words[i:i + p] * rng.randint(2, 9)
        out.append("".join(w + rng.choice([" ", " ", " ", "\n", "\n\n", " \t", "\x0b"]) for w in words))
    return out


ODD = [None, "", " \n", "one", "one one", " a", "a ", "\x0c", "<P> a b c", "a <S", "b<<P", "it's \x1c \x85they\n\n", "- a\n- a\n* b...\nc…\n", "ÀÉ ß #*$%&|<>", "🙂 🙂 🙂 🙂 🙂 🙂 é", "w " * 40_000, "u v w " * 30_000, " ".join(map(str, range(60_000)))]


@pytest.fixture(scope="module")
def texts():
    return [*ODD, *ODD, *made_up(3, 400)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(None if i == 5 else i // 2, t, "old", -1, "old") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words int, form string").repartition(7)


def bag(rows):
    return sorted(map(repr, rows))


def plain_measures(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
        "n_stop_words": sum(w.lower() in quality.STOP_WORDS for w in words),
        "n_bullet_lines": sum(x.lstrip(" \t")[:1] in tuple("-*•‣●▪◦·") for x in lines),
        "n_ellipsis_lines": sum(x.rstrip(quality.WHITE).endswith(("...", "…")) for x in lines),
    }


def test_quality_measures(docs, texts):
    got = quality.assess(docs).collect()
    want = [plain_measures(t) for t in texts]
    assert bag(tuple(r[m] for m in want[0]) for r in got) == bag(tuple(w.values()) for w in want)
    assert {type(r["kept"]) for r in got} == {bool} and {r["form"] for r in got} == {"old"}
    assert quality.assess(docs.limit(0)).count() == 0


def test_quality_rules(spark):
    rows = spark.createDataFrame([("the cat and the dog $ $ $",), ("",), (None,)], "body string")
    table = [quality.Rule("symbols", "n_symbols", "n_words", most=0.25), quality.Rule("words", "n_words", least=1, most=7), quality.Rule("stop", "n_stop_words", "n_words", least=0.9)]
    got = [(r["why"], r["ok"]) for r in quality.assess(rows, table, "body", "why", "ok").collect()]
    assert got == [(["symbols", "words", "stop"], False), (["words"], False), (["words"], False)]
    assert quality.assess(rows, [], "body").where("kept").count() == 3


def test_quality_is_one_projection_without_functions_of_ours(docs):
    plan = quality.assess(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Exchange hash|Sort ", plan)


def plain_fim(key, text):
    units = UNIT.findall(text or "")
    n = len(units)
    hex_ = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h = [int(hex_[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text or ""
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle(docs):
    rows = docs.select("doc_id", "text").collect()
    out = fim.transform(docs).withColumn("back", fim.restore())
    got = out.collect()
    names = ["n_units", "form", "prefix_chars", "middle_chars", "output"]
    assert bag((r["doc_id"], r["text"], *(r[c] for c in names)) for r in got) == bag((*r, *plain_fim(*r)) for r in rows)
    assert all(r["back"] == (r["text"] or "") and r["kept"] == "old" for r in got)
    assert {r["form"] for r in got} == {"plain", "spm", "psm"} and fim.transform(docs.limit(0)).count() == 0


def plain_runs(words, least=6, repeats=4):
    """Every maximal stretch at every lag; of equal stretches the smallest period."""
    n, found = len(words), {}
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, repeats * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in found.items())


@pytest.mark.parametrize("least,repeats", [(6, 4), (2, 3), (20, 5)])
def test_runs(docs, least, repeats):
    got = runs.find_runs(docs, least=least, repeats=repeats).collect()
    assert len(got) == docs.count()
    for r in got:
        words = WORD.findall(r["text"] or "")
        if len(words) < 2_000:
            want = plain_runs(words, least, repeats)
        else:
            q = len(set(words))
            want = [(0, len(words), q)] if q < 4 else []
        assert [tuple(x) for x in r["runs"]] == want
        drop = {i for a, n, q in want for i in range(a + q, a + n)}
        assert r["collapsed"] == " ".join(w for i, w in enumerate(words) if i not in drop)
        assert r["n_words"] == len(words) and r["kept"] == "old"
    assert runs.find_runs(docs.limit(0)).count() == 0


def test_overlapping_and_nested_runs(spark):
    """Runs that share words, runs inside a period of a longer run, long runs beside rare words."""
    inner = "a a a a a a b c d e f g h i j k l".split()
    cases = [inner * 5, ["x"] * 9 + ["x", "y"] * 6 + ["y"] * 8, ["p", "q"] * 500 + ["r"] + ["q", "p"] * 500, [*map(str, range(700))] * 5 + ["end"], [c for k in range(300) for c in ("z", f"{k % 7}")]]
    rows = spark.createDataFrame([(" ".join(c),) for c in cases], "text string").coalesce(1)
    for r, c in zip(runs.find_runs(rows).collect(), cases, strict=True):
        assert [tuple(x) for x in r["runs"]] == plain_runs(c)


def test_planted_texts(docs):
    """The tenth of the texts that the registered query changes."""
    by_id = {}
    for key, text in docs.select("doc_id", "text").collect():
        h = fold_of(key, 1 << 32)
        words = WORD.findall(text or "")
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            text = " ".join(words[i] if i < a else words[a + (i - a) % p] for i in range(n))
        by_id.setdefault(key, []).append(text)
    want = [(k, t) for k, ts in by_id.items() for t in ts]
    assert bag(map(tuple, _planted(docs).collect())) == bag(want)


def test_query_of_runs(spark):
    """All columns of the registered query, from the plain scan of its texts."""
    sf = "/root/testdata/sf0.001"
    texts = dict(map(tuple, _planted(read(spark, sf, "documents")).collect()))
    got = op13_periodic_runs(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        words = WORD.findall(texts[r["doc_id"]] or "")
        found = plain_runs(words)
        best = min(found, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        start, length, period = best or (None, None, None)
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(found), start, length, period)
        assert r["exponent_milli"] == (1000 * length // period if best else None)
        drop = {i for a, n, q in found for i in range(a + q, a + n)}
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert r["runs_sha256"] == sha("".join(f"{a},{n},{q}\n" for a, n, q in found))
        assert r["collapsed_sha256"] == sha(" ".join(w for i, w in enumerate(words) if i not in drop))
