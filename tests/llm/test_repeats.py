import hashlib
import random

from cinerank.llm import repeats
from cinerank.llm.common import read

SF = "/root/testdata/sf0.001"


def brute(rows):
    """rows in order: (id, bytes); what each loses."""
    seen, out = set(), []
    for key, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        gone = bytearray(len(t))
        for i in range(len(t) - 99):
            w = t[i:i + 100]
            if w in seen:
                gone[i:i + 100] = b"\1" * 100
            else:
                seen.add(w)
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((key, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is None, r))


def got(df):
    rows = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()]
    return sorted(rows, key=lambda r: (r[0] is None, r))


def test_documents_against_brute_force(spark):
    docs = read(spark, SF, "documents")
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in docs.select("doc_id", "text").collect()]
    assert got(repeats.remove_repeats(docs)) == brute(rows)


def test_planted_and_periodic(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(30) for _ in range(4)]
    rows = [(1, None), (2, ""), (3, "a" * 99), (4, "a" * 100), (5, "a" * 150), (6, "ab" * 120), (7, "ba" * 120), (8, "é" * 80)]
    rows += [(k, text(20) + rng.choice(shared)[:rng.randrange(90, 200)] + text(10)) for k in range(10, 60)]
    rows += [(k, shared[k % 4]) for k in range(60, 70)] + [(70, shared[0] + shared[0]), (None, shared[1] + "x" * 120)]
    docs = spark.createDataFrame([(*r, 1, "n") for r in rows], "doc_id long, text string, block int, name string").repartition(5)
    assert got(repeats.remove_repeats(docs)) == brute([(k, (t or "").encode()) for k, t in rows])
    assert repeats.remove_repeats(docs.limit(0)).count() == 0


def test_equal_rows(spark):
    docs = spark.createDataFrame([(1, "x" * 50 + "y" * 70)] * 3, "doc_id long, text string")
    assert sorted(r["n_removed"] for r in repeats.remove_repeats(docs).collect()) == [0, 120, 120]
