import os

from cinerank import jobs
from cinerank.operators import stats
from cinerank.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def write_lines(d, name, lines):
    p = os.path.join(d, name)
    os.makedirs(p, exist_ok=True)
    with open(os.path.join(p, "part-0.txt"), "w") as f:
        f.write("\n".join(lines) + "\n")
    return p


def test_load_job(spark, tmp_dir):
    mp = write_lines(tmp_dir, "m", ["1^A^d^1 min^x^1995^en^Drama|Crime^a^b", "2^B^d^1 min^x^1995^en^Drama^a^b"])
    rp = write_lines(tmp_dir, "r", ["1,1,4.0,100", "2,1,3.0,200", "1,2,5.0,300"])
    tp = write_lines(tmp_dir, "t", ["1,1,dark,100", "2,1,noir,200"])
    paths = jobs.load_job(spark, mp, rp, tp, os.path.join(tmp_dir, "out"), rating_buckets=8)
    docs = {r["_id"]: r.tags for r in spark.read.json(paths["documents"]).collect()}
    assert docs == {1: "dark|noir", 2: None}
    stored = spark.read.parquet(paths["ratings"])
    assert stored.count() == 3 and "_uid_b8" in stored.columns


def test_statistics_job_matches_operators(spark, tmp_dir):
    ratings, movies = fx.ratings(spark, SF), fx.movies(spark, SF)
    paths = jobs.statistics_job(ratings, movies, os.path.join(tmp_dir, "stats"), min_avg=3.2, min_count=5, write_input=True)
    assert set(paths) == {"rate_more", "rate_more_recently", "average", "genres_top", "high_quality", "recent_top"}
    got = sorted(tuple(r) for r in spark.read.parquet(paths["genres_top"]).collect())
    exp = sorted(tuple(r) for r in stats.genre_top_n(movies, stats.average_scores(ratings), 10).collect())
    assert got == exp
    assert spark.read.parquet(paths["recent_top"]).count() == 10


def test_offline_job_writes_lists(spark, tmp_dir):
    ratings, movies = fx.ratings(spark, SF), fx.movies(spark, SF)
    paths = jobs.offline_job(ratings, movies, os.path.join(tmp_dir, "offline"), threshold=0.3)
    recs = spark.read.parquet(paths["user_recs"]).collect()
    assert len(recs) > 0 and all(len(r.recs) <= 20 for r in recs)
    edges = spark.read.parquet(paths["item_edges"]).count()
    lists = spark.read.parquet(paths["item_recs"]).collect()
    assert edges == sum(len(r.recs) for r in lists)
    assert jobs.packed(spark.read.parquet(paths["user_recs"])).count() == len(recs)
