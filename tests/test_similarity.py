import numpy as np

from cinerank.operators import similarity


def brute(vecs, t):
    out = set()
    for i, a in vecs.items():
        for j, b in vecs.items():
            na, nb = np.linalg.norm(a), np.linalg.norm(b)
            if i != j and na > 0 and nb > 0 and float(a @ b) / (na * nb) > t:
                out.add((i, j))
    return out


def test_blocked_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    vecs = {i: rng.normal(size=8) for i in range(120)}
    vecs[200] = np.zeros(8)  # zero vector: never similar
    vecs[201] = vecs[0].copy()  # identical vectors: cosine 1
    df = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in vecs.items()], "mid int, features array<float>")
    vecs32 = {k: np.asarray(v, dtype=np.float32).astype(np.float64) for k, v in vecs.items()}
    got = {(r.mid, r.rid) for r in similarity.similar_pairs(df, 0.5, block_rows=16).collect()}
    assert got == brute(vecs32, 0.5)
    assert (0, 201) in got and not any(200 in p for p in got)


def test_threshold_is_strict(spark):
    # cos = 0.6 exactly for (3,4) . (4,3)/25 = 24/25 = 0.96; use (1,0) and (0.6, 0.8)
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.6, 0.8]), (3, [0.8, 0.6])], "mid int, features array<float>")
    got = {(r.mid, r.rid): r.r for r in similarity.similar_pairs(df, 0.6, round_to=6).collect()}
    assert (1, 2) not in got and got[(1, 3)] == 0.8 and got[(3, 1)] == 0.8


def test_lsh_is_subset_of_exact(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(20, 16))
    rows = []
    for i in range(200):
        v = base[i % 20] + 0.1 * rng.normal(size=16)
        rows.append((i, [float(x) for x in v]))
    df = spark.createDataFrame(rows, "mid int, features array<float>")
    exact = {(r.mid, r.rid) for r in similarity.similar_pairs(df, 0.8).collect()}
    approx = {(r.mid, r.rid) for r in similarity.similar_pairs_lsh(df, 0.8).collect()}
    assert approx <= exact and len(approx) >= 0.5 * len(exact)


def test_similar_lists_sorted(spark):
    e = spark.createDataFrame([(1, 2, 0.7), (1, 3, 0.9), (1, 4, 0.9)], "mid int, rid int, r double")
    got = similarity.similar_lists(e).first()
    assert [(x.rid, x.r) for x in got.recs] == [(3, 0.9), (4, 0.9), (2, 0.7)]


def test_copies_are_collapsed_and_blocks_stay_balanced(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(9)
    base = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(60)]
    hot = [(0, base[0][1])] * 40  # a group of copies: 40 of 100 rows
    df = spark.createDataFrame(base + hot, "mid int, features array<float>")
    got = [(r.mid, r.rid) for r in similarity.similar_pairs(df, 0.3, block_rows=16).collect()]
    vecs = {k: np.asarray(v, dtype=np.float32).astype(np.float64) for k, v in base}
    assert sorted(got) == sorted(brute(vecs, 0.3))  # each item pair once
    u = similarity.nonzero_vectors(df).dropDuplicates(["mid", "_u"])
    sizes = u.groupBy(F.pmod(F.xxhash64("mid", "_u"), F.lit(4))).count().collect()
    assert max(r["count"] for r in sizes) < 40


def test_lsh_equals_the_join_on_buckets_without_making_it(spark):
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(11)
    x = rng.standard_normal((150, 6))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    got_df = similarity.similar_pairs_lsh(spark.createDataFrame([*rows, rows[4]], "mid int, features array<double>"), 0.5, bucket_length=0.4, num_hash_tables=2, block_rows=40)
    plan = got_df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    got = {(r.mid, r.rid): r.r for r in got_df.collect()}
    u = spark.createDataFrame([(i, Vectors.dense(v / np.linalg.norm(v))) for i, v in enumerate(x)], ["id", "v"])
    lsh = BucketedRandomProjectionLSH(inputCol="v", outputCol="h", bucketLength=0.4, numHashTables=2, seed=7).fit(u)
    joined = lsh.approxSimilarityJoin(u, u, 1.0, distCol="d").selectExpr("datasetA.id a", "datasetB.id b", "d").where("a <> b")
    want = {(r.a, r.b): 1 - r.d**2 / 2 for r in joined.collect()}
    assert set(got) == set(want) and len(want) < len(brute(dict(enumerate(x)), 0.5))
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_a_vector_travels_once_for_each_of_half_the_blocks(spark):
    rng = np.random.default_rng(13)
    vecs = {i: rng.normal(size=6) for i in range(200)}
    df = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in vecs.items()], "mid int, features array<double>")
    for rows in (10, 30, 1000):
        got = similarity.similar_pairs(df, 0.4, block_rows=rows)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and "FlatMapGroups" not in plan  # blocks stream, no pair of them is loaded whole
        found = [(r.mid, r.rid) for r in got.collect()]
        assert sorted(found) == sorted(brute(vecs, 0.4)) and len(found) > 1000
