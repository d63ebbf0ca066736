import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cinerank import sinks
from cinerank.operators import catalogue
from cinerank.sources import load_movies_text, load_ratings_text, load_tags_text, read_table
from cinerank.schemas import RATING


def write_lines(d, name, lines):
    p = os.path.join(d, name)
    os.makedirs(p, exist_ok=True)
    with open(os.path.join(p, "part-0.txt"), "w") as f:
        f.write("\n".join(lines) + "\n")
    return p


def test_movie_scan_trims_and_keeps_trailing_empty_fields(spark, tmp_dir):
    p = write_lines(tmp_dir, "movies", [
        "42^The Paper Kite^A kite and its string^95 minutes^May 2, 2011^2010^Welsh ^Comedy|Family ^Ann Ash|Bo Birch^Cy Cedar",
        "7^Empty^^^^^^^^",
        "8^Extra^a^b^c^d^e^f^g^h^ignored",
    ])
    rows = {r.mid: r for r in load_movies_text(spark, p).collect()}
    assert rows[42].genres == "Comedy|Family" and rows[42].language == "Welsh"
    assert rows[7].genres == "" and rows[7].directors == ""
    assert rows[8].directors == "h"


def test_movie_scan_bad_id_strict_and_lenient(spark, tmp_dir):
    p = write_lines(tmp_dir, "bad", ["x1^a^b^c^d^e^f^g^h^i", "2^a^b^c^d^e^f^g^h^i", "3^short"])
    with pytest.raises(Exception):
        load_movies_text(spark, p).collect()
    got = sorted(((r.mid or -1), r.name) for r in load_movies_text(spark, p, lenient=True).collect())
    assert got == [(-1, "a"), (2, "a"), (3, "short")]


def test_ratings_and_tags_scans(spark, tmp_dir):
    rp = write_lines(tmp_dir, "ratings", ["3,17,4.5,1500000000", "3,18,1.0,1500000060"])
    assert [tuple(r) for r in load_ratings_text(spark, rp).collect()] == [(3, 17, 4.5, 1500000000), (3, 18, 1.0, 1500000060)]
    tp = write_lines(tmp_dir, "tags", ['9,21, harbour ,1400000000', '9,22,"tea, cake",1400000500'])
    got = [tuple(r) for r in load_tags_text(spark, tp).collect()]
    assert got == [(9, 21, "harbour", 1400000000), (9, 22, "tea, cake", 1400000500)]


def test_bad_rating_strict_fails_lenient_nulls(spark, tmp_dir):
    rp = write_lines(tmp_dir, "r2", ["1,31,abc,1500000000", "2,5"])
    with pytest.raises((PySparkException, Exception)):
        load_ratings_text(spark, rp).collect()
    got = sorted(load_ratings_text(spark, rp, lenient=True).collect(), key=lambda r: r.uid)
    assert got[0].score is None and got[1].timestamp is None


def test_tags_join_all_null_and_repeated(spark):
    movies = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "mid int, name string")
    tags = spark.createDataFrame(
        [(1, 1, "zeta", 0), (2, 1, "alpha", 0), (3, 1, "zeta", 0), (1, 2, None, 0)], "uid int, mid int, tag string, timestamp int")
    got = {r.mid: r.tags for r in catalogue.movies_with_tags(movies, tags).collect()}
    assert got == {1: "alpha|zeta", 2: "", 3: None}


def test_read_table_conforms_schema(spark, tmp_dir):
    p = os.path.join(tmp_dir, "r.parquet")
    spark.createDataFrame([(1, 2, 3, 4, "x")], "UID long, Mid long, score int, timestamp long, extra string").write.parquet(p)
    df = read_table(spark, p, schema=RATING)
    assert df.schema == RATING and df.first() == (1, 2, 3.0, 4)


def test_layout_and_export(spark, tmp_dir):
    df = spark.range(100).select(F.col("id").cast("int").alias("uid"), (F.col("id") % 7).cast("int").alias("mid"))
    p = os.path.join(tmp_dir, "layout")
    sinks.write_layout(df, p, "uid", partitions=4)
    files = [f for f in os.listdir(p) if f.endswith(".parquet")]
    assert len(files) == 4 and spark.read.parquet(p).count() == 100
    # each file covers a disjoint uid range
    ranges = sorted((r["lo"], r["hi"]) for r in spark.read.parquet(p).groupBy(F.input_file_name()).agg(
        F.min("uid").alias("lo"), F.max("uid").alias("hi")).collect())
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    e = os.path.join(tmp_dir, "docs")
    dup = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "mid int, name string")
    sinks.export_documents(dup, e)
    back = spark.read.json(e)
    assert sorted(r["_id"] for r in back.collect()) == [1, 2]


def test_write_table_and_bucketed(spark, tmp_dir):
    df = spark.range(40).select(F.col("id").cast("int").alias("uid"), (F.col("id") % 5).cast("int").alias("mid"))
    p = os.path.join(tmp_dir, "full")
    sinks.write_table(df, p)
    sinks.write_table(df.limit(3), p)  # full refresh replaces the previous content
    assert spark.read.parquet(p).count() == 3
    sinks.write_bucketed(df, "ratings_by_uid", "uid", 4, path=os.path.join(tmp_dir, "bucketed"))
    t = spark.table("ratings_by_uid")
    assert t.count() == 40
    j = t.join(spark.table("ratings_by_uid").withColumnRenamed("mid", "m2"), "uid")
    assert "Exchange hashpartitioning" not in j._jdf.queryExecution().executedPlan().toString()
    spark.sql("DROP TABLE ratings_by_uid")
