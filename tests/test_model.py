import numpy as np
from pyspark.sql import functions as F

from cinerank.operators import model
from cinerank.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def test_blocked_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(11)
    U = rng.normal(size=(37, 6))
    V = rng.normal(size=(53, 6))
    users = spark.createDataFrame([(i, [float(x) for x in U[i]]) for i in range(37)], "uid int, features array<float>")
    items = spark.createDataFrame([(j, [float(x) for x in V[j]]) for j in range(53)], "mid int, features array<float>")
    got = {}
    for r in model.blocked_top_k(users, items, 5, block_rows=8).collect():
        got.setdefault(r.uid, []).append((r["rank"], r.rid))
    S = U.astype(np.float32).astype(np.float64) @ V.astype(np.float32).astype(np.float64).T
    for u in range(37):
        pos = [(S[u, j], j) for j in range(53) if S[u, j] > 0]
        exp = [j for _, j in sorted(pos, key=lambda t: (-t[0], t[1]))[:5]]
        assert [rid for _, rid in sorted(got.get(u, []))] == exp


def test_user_recommendations_properties_and_paths_agree(spark):
    ratings = fx.ratings(spark, SF)
    movies = fx.movies(spark, SF)
    m = model.train_als(ratings, rank=8, max_iter=3, reg=0.1, seed=1)
    als = model.user_recommendations(m, ratings, movies, 10, nested=False, method="als")
    blk = model.user_recommendations(m, ratings, movies, 10, nested=False, method="blocked")
    a = {(r.uid, r.rid): r.r for r in als.collect()}
    b = {(r.uid, r.rid): r.r for r in blk.collect()}
    assert a.keys() == b.keys()
    assert all(abs(a[k] - b[k]) < 1e-4 for k in a)
    per_user = als.groupBy("uid").agg(F.count("*").alias("n"), F.min("r").alias("lo")).collect()
    assert all(r.n <= 10 and r.lo > 0 for r in per_user)
    # catalogue restriction: only even items
    even = movies.where(F.col("mid") % 2 == 0)
    sub = model.user_recommendations(m, ratings, even, 10, nested=True)
    assert all(x.rid % 2 == 0 for r in sub.collect() for x in r.recs)
    for r in sub.collect():
        scores = [x.r for x in r.recs]
        assert scores == sorted(scores, reverse=True)


def test_rmse_duplicates_modes(spark):
    ratings = spark.createDataFrame(
        [(1, 1, 5.0, 0), (1, 1, 1.0, 0), (1, 2, 3.0, 0), (2, 1, 4.0, 0), (2, 2, 2.0, 0), (3, 2, 4.0, 0)],
        "uid int, mid int, score double, timestamp int")
    m = model.train_als(ratings, rank=2, max_iter=5, reg=0.1, seed=3)
    pred = {(r.uid, r.mid): r.prediction for r in model.predict(m, ratings.select("uid", "mid").distinct()).collect()}
    rows = [(u, i, s) for u, i, s, _ in ratings.collect()]
    exp_row = np.sqrt(np.mean([(s - pred[(u, i)]) ** 2 for u, i, s in rows]))
    # the join of real and predicted on (uid, mid) counts pair (1,1) four times
    join_err = [(s - pred[(u, i)]) ** 2 for u, i, s in rows for u2, i2, _ in rows if (u2, i2) == (u, i)]
    exp_join = np.sqrt(np.mean(join_err))
    assert abs(model.rmse(m, ratings).first().rmse - exp_row) < 1e-5
    assert abs(model.rmse(m, ratings, duplicates="join").first().rmse - exp_join) < 1e-5


def test_grid_orders_by_rmse(spark):
    ratings = fx.ratings(spark, SF)
    g = model.tune_als(ratings, ranks=(2, 4), regs=(1.0, 0.01), max_iter=2, parallelism=2).collect()
    assert len(g) == 4 and [r.rmse for r in g] == sorted(r.rmse for r in g)
    assert model.best_params(model.tune_als(ratings, ranks=(2,), regs=(0.1,), max_iter=1)).count() == 1


def test_item_similarity_lists(spark):
    ratings = fx.ratings(spark, SF)
    m = model.train_als(ratings, rank=4, max_iter=2, reg=0.1, seed=1)
    lists = model.item_similarity(m, 0.9, nested=True).collect()
    for r in lists:
        assert all(x.r > 0.9 and x.rid != r.mid for x in r.recs)
    edges = model.item_similarity(m, 0.9)
    assert edges.count() == sum(len(r.recs) for r in lists)


def test_a_fit_of_the_grid_leaves_neither_caches_nor_shuffle_files(spark):
    rows = [(u, m, float((u * m) % 5 + 1)) for u in range(12) for m in range(9) if (u + m) % 3]
    ratings = spark.createDataFrame(rows, "uid int, mid int, score double")
    sc = spark.sparkContext._jsc.sc()
    held = lambda: (set(sc.getPersistentRDDs().keySet().mkString(",").split(",")), sc.env().mapOutputTracker().shuffleStatuses().size())
    cached, shuffles = held()
    fits = []

    def train(data, rank, max_iter, reg, seed):
        left, n = held()
        fits.append((left - cached, n - shuffles))
        return model.train_als(data, rank, max_iter, reg, seed)

    grid = model.tune_als(ratings, (2, 3), (0.1, 0.01), 2, train=train)
    assert len(fits) == 4 and all(not left for left, _ in fits)
    assert max(n for _, n in fits) <= 0
    m = model.train_als(ratings, 2, 2, 0.1, 42)
    before = m.userFactors.orderBy("id").collect()
    model.release(m)
    assert m.userFactors.orderBy("id").collect() == before  # computed again
    assert grid.count() == 4
