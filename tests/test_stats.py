from cinerank.operators import stats

R = "uid int, mid int, score double, timestamp int"


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_rating_counts_null_mid_counts_zero(spark):
    df = spark.createDataFrame([(1, 10, 4.0, 1), (2, 10, 3.0, 2), (3, None, 2.0, 3)], R)
    got = {r.mid: r["count"] for r in stats.rating_counts(df).collect()}
    assert got == {10: 2, None: 0}


def test_average_half_up_ties(spark):
    # 1.005 and 2.675 are exact averages of these scores
    data = [(u, 1, s, 0) for u, s in enumerate([1.0] * 199 + [2.0])]  # 201/200 = 1.005
    data += [(u, 2, s, 0) for u, s in enumerate([2.5, 2.85] * 0 + [2.0, 3.0, 3.0, 2.7])]  # 10.7/4 = 2.675
    got = {r.mid: r.avgscore for r in stats.average_scores(spark.createDataFrame(data, R)).collect()}
    assert got == {1: 1.01, 2: 2.68}


def test_monthly_counts_split_at_midnight_utc(spark):
    df = spark.createDataFrame([(1, 5, 4.0, 1262303999), (2, 5, 4.0, 1262304000), (3, 5, 1.0, 1262304001)], R)
    assert rows(stats.monthly_rating_counts(df), "mid", "yearmonth", "count") == [(5, 200912, 1), (5, 201001, 2)]


def test_genre_top_n_edges(spark):
    movies = spark.createDataFrame(
        [(1, "Action|Drama||"), (2, ""), (3, "Action"), (4, None), (5, "Drama"), (6, "Drama")], "mid int, genres string")
    avg = spark.createDataFrame([(1, 4.0), (2, 3.0), (3, 4.0), (4, 5.0), (5, 2.0)], "mid int, avgscore double")
    got = rows(stats.genre_top_n(movies, avg, 1), "gen", "mid", "rank")
    # ties on 4.0 in Action go to the smaller mid; '' is a genre of its own; null genres vanish; mid 6 has no average
    assert got == [("", 2, 1), ("Action", 1, 1), ("Drama", 1, 1)]
    nested = {r.gen: [(x.rid, x.r) for x in r.recs] for r in stats.genre_top_n(movies, avg, 2, nested=True).collect()}
    assert nested["Drama"] == [(1, 4.0), (5, 2.0)] and nested["Action"] == [(1, 4.0), (3, 4.0)]


def test_high_quality_thresholds_use_unrounded_average(spark):
    data = []
    for i in range(3):  # mid 1: avg 3.5 exactly -> excluded (strict)
        data += [(i * 2, 1, 3.0, 0), (i * 2 + 1, 1, 4.0, 0)]
    data += [(u, 2, 4.0, 0) for u in range(4)]  # avg 4, count 4
    data += [(u, 3, 4.0, 0) for u in range(6)]  # avg 4, count 6 -> ranked before mid 2
    data += [(u, 4, 5.0, 0) for u in range(2)]  # count 2 -> excluded by count > 3
    got = rows(stats.high_quality(spark.createDataFrame(data, R), 3.5, 3), "rank", "mid", "avg", "count")
    assert got == [(1, 3, 4.0, 6), (2, 2, 4.0, 4)]


def test_global_rank_is_dense_over_many_partitions(spark):
    from pyspark.sql import functions as F

    from cinerank.operators.ranking import global_row_number

    df = spark.range(1000).select((F.col("id") % 97).alias("k"), F.col("id"))
    got = global_row_number(df, [F.desc("k"), F.asc("id")], partitions=7).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 1001))
    exp = sorted(range(1000), key=lambda i: (-(i % 97), i))
    assert [r["id"] for r in got] == exp


def test_recent_top_n_strict_bound(spark):
    mx = 10_000_000
    data = [(1, 1, 3.0, mx), (2, 2, 3.0, mx - 7776000), (3, 2, 3.0, mx - 7776000), (4, 3, 3.0, mx - 7775999)]
    got = rows(stats.recent_top_n(spark.createDataFrame(data, R), 10), "mid", "count")
    assert got == [(1, 1), (3, 1)]
