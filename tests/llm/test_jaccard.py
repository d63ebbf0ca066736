import itertools

from cinerank.llm import jaccard
from cinerank.llm.common import read

SF = "/root/testdata/sf0.001"


def shingles(text):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def classes(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and len(a & b) >= 0.8 * len(a | b):
            parent[max(find(i), find(j))] = min(find(i), find(j))
    out = {}
    for i, (k, _) in enumerate(rows):
        out.setdefault(find(i), []).append(k)
    return sorted(sorted(v) for v in out.values())


def got(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["class_id"], []).append(r["doc_id"])
    assert all(k == min(v) for k, v in out.items())
    return sorted(sorted(v) for v in out.values())


def test_classes_against_brute_force(spark):
    docs = read(spark, SF, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert got(jaccard.near_duplicates(docs)) == classes(rows)


def test_chain_and_group_of_near_copies(spark):
    base = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(40):  # each differs from the first in one word; some pairs of them lie below 0.8 of a third
        w = list(base)
        w[3 * k % 120] = f"x{k}"
        rows.append((k, " ".join(w)))
    for k in range(6):  # a chain: neighbours are near, its ends are not
        rows.append((100 + k, " ".join(f"c{i}" for i in range(8 * k, 8 * k + 130))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(jaccard.near_duplicates(docs)) == classes(rows)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  b"), (5, "A  b"), (None, "a b"), (7, "x " * 30_000)]
    docs = spark.createDataFrame([(*r, "n") for r in rows], "doc_id long, text string, node string")
    out = sorted((r["doc_id"] or 0, r["class_id"], r["n_links"], r["n_copies"]) for r in jaccard.near_duplicates(docs).collect())
    assert out == [(0, 4, 0, 3), (1, 1, 0, 0), (2, 2, 0, 0), (3, 3, 0, 0), (4, 4, 0, 3), (5, 4, 0, 3), (5, 4, 0, 3), (7, 7, 0, 0)]
    assert jaccard.near_duplicates(docs.limit(0)).count() == 0


def links(rows):
    """The number of other texts that reach the threshold, by id; rows with the same words are one text."""
    sets = [(k, shingles(t), " ".join((t or "").lower().split())) for k, t in rows]
    return {k: len({u for _, b, u in sets if u != t and a and b and len(a & b) >= 0.8 * len(a | b)}) for k, a, t in sets}


def test_every_link_counts(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SIDE", 8)
    monkeypatch.setattr(jaccard, "CLASS_SIDE", 8)
    base = [f"w{i}" for i in range(120)]
    rows = [(k, " ".join(f"x{k}" if i == 3 * k else w for i, w in enumerate(base))) for k in range(40)]
    rows += [(100 + k, " ".join(f"c{i}" for i in range(8 * k, 8 * k + 130))) for k in range(6)]
    rows += [(200 + k, f"{'same ' * 5}" + " ".join(f"t{i}" for i in range(60)) + f" end{k}") for k in range(3)]  # three texts, all near
    rows += [(300, rows[-1][1]), (301, "alone and only here, of eight words in all")]
    want = links(rows)
    assert [want[200 + k] for k in range(3)] == [2, 2, 2]
    got_ = {r["doc_id"]: r["n_links"] for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got_ == want


def test_links_of_the_fixture_against_brute_force(spark):
    docs = read(spark, SF, "documents")
    want = links([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert {r["doc_id"]: r["n_links"] for r in jaccard.near_duplicates(docs).collect()} == want
