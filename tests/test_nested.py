"""Nested schemas, lists as edges, chunked lists, the clustered layout and grid scoring."""

import glob
from types import SimpleNamespace

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinerank import schemas, sinks
from cinerank.functions.recs import edges_of_lists
from cinerank.operators import catalogue, model, online, scoring, similarity
from cinerank.schemas import conform
from cinerank.sources.tables import read_table


def test_conform_goes_down(spark):
    df = spark.sql("""SELECT 1L AS MID, array(named_struct('R', '0.5', 'extra', 1, 'RID', 7L), null) AS recs,
        map(1, named_struct('A', array('3', '4'))) AS M, named_struct('in', named_struct('X', '1')) AS s""")
    want = T.StructType.fromDDL("mid int, recs array<struct<rid: int, r: double>>, m map<bigint, struct<a: array<int>>>, s struct<in: struct<x: int>>")
    out = conform(df, want)
    assert out.schema.simpleString() == want.simpleString()
    r = out.first()
    assert r["mid"] == 1 and [None if x is None else tuple(x) for x in r["recs"]] == [(7, 0.5), None]
    assert r["m"][1]["a"] == [3, 4] and r["s"]["in"]["x"] == 1


def test_conform_missing_and_wrong(spark):
    df = spark.sql("SELECT 1 AS mid, array(named_struct('rid', 'x')) AS recs")
    with pytest.raises(ValueError, match="no field r"):
        conform(df, schemas.MOVIE_RECS)
    assert [tuple(x) for x in conform(df, schemas.MOVIE_RECS, lenient=True).first()["recs"]] == [(None, None)]
    flat = spark.sql("SELECT 1 AS mid, 'text' AS recs")
    with pytest.raises(ValueError, match="is no array"):
        conform(flat, schemas.MOVIE_RECS)
    assert conform(flat, schemas.MOVIE_RECS, lenient=True).first()["recs"] is None
    none = spark.sql("SELECT 1 AS mid, cast(null AS array<struct<rid: int, r: double>>) AS recs, cast(null AS struct<x: int>) AS s")
    assert conform(none, schemas.MOVIE_RECS).first()["recs"] is None
    assert conform(none, T.StructType.fromDDL("s struct<x: int>")).first()["s"] is None


def test_bucket_columns_survive_a_typed_read(spark, tmp_dir):
    r = spark.createDataFrame([(u, u % 7, 1.0, u) for u in range(200)], "uid int, mid int, score double, timestamp int")
    sinks.write_layout(r, f"{tmp_dir}/r", "uid", buckets=8)
    stored = read_table(spark, f"{tmp_dir}/r", schema=schemas.RATING)
    assert stored.columns == ["uid", "mid", "score", "timestamp", "_uid_b8"]
    cut = online.restrict(stored, spark.createDataFrame([(3,)], "uid int"), ["uid"])
    assert "_uid_b8" in cut._jdf.queryExecution().executedPlan().toString() and cut.count() == 1


def test_lists_keep_the_last_value(spark):
    lists = spark.createDataFrame([(1, [(2, 0.5), (3, 0.7), (2, 0.4)]), (2, []), (3, None), (1, [(9, 0.1)])], "mid int, recs array<struct<rid: int, r: double>>")
    assert sorted(map(tuple, edges_of_lists(lists).collect())) == [(1, 2, 0.4), (1, 3, 0.7), (1, 9, 0.1)]


def test_chunks_bound_rows_of_a_hot_item(spark):
    """A third of all tags on one item: no row and no task holds them all, and the parts join to the whole list."""
    rows = [(5, 1, f"t{i % 900:03d}", i) for i in range(2000)] + [(5, i % 500, f"x{i}", i) for i in range(4000)] + [(5, 2, None, 0)]
    tags = spark.createDataFrame(rows, "uid int, mid int, tag string, timestamp int").repartition(6)
    parts = catalogue.tag_chunks(tags, 50)
    assert parts.agg(F.max("n_tags")).first()[0] == 50
    joined = parts.groupBy("mid").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "tags"))), lambda x: x["tags"]), "|").alias("tags"))
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, catalogue.tag_lists(tags).collect()))


def test_similar_list_chunks(spark):
    e = spark.createDataFrame([(0, i, round(1 / i, 6)) for i in range(1, 300)] + [(1, 2, 0.9)], "mid int, rid int, r double")
    parts = similarity.similar_list_chunks(online.ranked_edges(e)).orderBy("mid", "chunk").collect()
    assert [len(p["recs"]) for p in parts] == [64, 64, 64, 64, 43, 1]
    assert [x["rid"] for p in parts[:5] for x in p["recs"]] == list(range(1, 300))


@pytest.mark.parametrize("skew", [False, True])
def test_clustered_layout_skips_on_either_key(spark, tmp_dir, skew):
    rng = np.random.default_rng(2)
    u, m = (rng.zipf(1.3, 20_000) % 5000 if skew else rng.integers(0, 5000, 20_000)), rng.integers(-50, 3000, 20_000)
    df = spark.createDataFrame([(int(a), int(b)) for a, b in zip(u, m)], "uid int, mid int").unionByName(spark.createDataFrame([(None, 1), (2, None)], "uid int, mid int"))
    sinks.write_clustered(df, f"{tmp_dir}/c", ["uid", "mid"], 64)
    back = spark.read.parquet(f"{tmp_dir}/c")
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
    spans = []
    for f in glob.glob(f"{tmp_dir}/c/part-*"):
        t = pq.read_table(f).to_pandas().dropna()
        if len(t):
            spans.append((len(t), t.uid.min(), t.uid.max(), t.mid.min(), t.mid.max()))
    assert len(spans) >= 50 and max(s[0] for s in spans) < 20_002 / 8
    for low, key in ((1, "uid"), (3, "mid")):
        values = back.select(key).where(f"{key} is not null").sample(0.005, 1).collect()
        share = np.mean([sum(s[low] <= v[0] <= s[low + 1] for s in spans) / len(spans) for v in values])
        assert share < 0.45, (key, share)


def fixed(spark, seed, users=50, items=30, dim=4):
    rng = np.random.default_rng(seed)
    f = lambda n: spark.createDataFrame([(i, [float(x) for x in rng.standard_normal(dim)]) for i in range(n)], "id int, features array<float>")
    return SimpleNamespace(userFactors=f(users), itemFactors=f(items))


@pytest.mark.parametrize("blocks", [None, (1, 1), (3, 5)])
def test_grid_errors_against_brute_force(spark, blocks):
    """Two models in one pass, repeated pairs, unknown users and items, a hot item; batches cut inside a pair."""
    models = [fixed(spark, 1), fixed(spark, 2, users=60)]
    rng = np.random.default_rng(3)
    rows = [(int(rng.integers(0, 70)), 4 if i % 3 == 0 else int(rng.integers(0, 35)), float(rng.integers(1, 6))) for i in range(900)] + [(1, 4, 3.0)] * 50 + [(None, 1, 1.0), (1, None, 1.0)]
    ratings = spark.createDataFrame(rows, "uid int, mid int, score double")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        got = {(r["model"], how): r["rmse"] for how in ("row", "join") for r in scoring.grid_rmse(models, ratings, how, blocks=blocks).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    for m, one in enumerate(models):
        u = {r["id"]: np.array(r["features"]) for r in one.userFactors.collect()}
        v = {r["id"]: np.array(r["features"]) for r in one.itemFactors.collect()}
        errors = [(a, b, (s - u[a] @ v[b]) ** 2) for a, b, s in rows if a in u and b in v]
        pairs = {}
        for a, b, e in errors:
            pairs.setdefault((a, b), []).append(e)
        joined = [e for es in pairs.values() for e in es for _ in es]
        assert got[m, "row"] == pytest.approx(np.sqrt(np.mean([e for _, _, e in errors])), rel=1e-9)
        assert got[m, "join"] == pytest.approx(np.sqrt(np.mean(joined)), rel=1e-9)


def test_no_known_rating_gives_null(spark):
    nothing = spark.createDataFrame([(999, 999, 1.0)], "uid int, mid int, score double")
    assert model.rmse(fixed(spark, 1), nothing).first()["rmse"] is None
    assert model.rmse(fixed(spark, 1), nothing.limit(0)).collect()[0]["rmse"] is None


def test_rounded_rerank_keeps_all_decimals(spark):
    """A score of many decimals gives the same list with and without rounding."""
    cands = spark.createDataFrame([(1, 5, 7, 0.9)], "uid int, mid int, rid int, r double")
    recents = spark.createDataFrame([(1, 9, 3.000049), (1, 8, 1.0)], "uid int, mid int, score double")
    edges = spark.createDataFrame([(7, 9, 0.9)], "mid int, rid int, r double")
    plain, rounded = (online.rerank(cands, recents, edges, 0.6, round_to=n).first()["score"] for n in (None, 6))
    assert rounded == pytest.approx(plain, abs=1e-6) and rounded == 2.700044


def test_blocked_predictions_as_joined(spark):
    """All columns, repeated rows, unknown ids and a column called prediction; blocks cut anywhere."""
    m = fixed(spark, 1)
    rows = [(i % 60, i % 40, float(i % 5), f"r{i % 7}", -1.0) for i in range(500)] + [(None, 1, 1.0, "x", 0.0), (1, None, 1.0, "x", 0.0), (2, 3, None, "y", 0.0)]
    pairs = spark.createDataFrame(rows, "uid int, mid int, score double, note string, prediction double")
    bag = lambda df: sorted((repr([r[c] for c in ("uid", "mid", "score", "note")]), round(r["prediction"], 9)) for r in df.collect())
    want = bag(model.predict(m, pairs.drop("prediction")))
    for blocks in (None, (4, 3)):
        out = scoring.blocked_predictions(m, pairs, blocks=blocks)
        assert out.columns == ["uid", "mid", "score", "note", "prediction"]
        assert bag(out) == want
    assert scoring.blocked_predictions(m, pairs.select("uid", "mid")).columns == ["uid", "mid", "prediction"]


def test_factor_copies_follow_the_ratings(spark, monkeypatch):
    """However many user blocks there are, no user and no item travels oftener than ratings name it; the errors stay."""
    m = fixed(spark, 1, users=400, items=200)
    rng = np.random.default_rng(5)
    ratings = spark.createDataFrame([(int(rng.integers(0, 400)), int(rng.integers(0, 200)), 3.0) for _ in range(500)], "uid int, mid int, score double")
    rows, _ = scoring._dealt([m], ratings, F.lit(0), 16, None)  # four users a block
    n = {r["_side"]: r["count"] for r in rows.groupBy("_side").count().collect()}
    assert n[0] == 400 and n[1] <= n[2] == 500
    few, many = (scoring.grid_rmse([m], ratings, block_doubles=d).first()["rmse"] for d in (scoring.BLOCK_DOUBLES, 16))
    assert few == pytest.approx(many, rel=1e-12)
    monkeypatch.setattr(scoring, "COPIES", 1 << 20)
    assert scoring.grid_rmse([m], ratings, block_doubles=16).first()["rmse"] == pytest.approx(few, rel=1e-12)


def test_each_group_has_its_own_task(spark):
    models = [fixed(spark, 1), fixed(spark, 2)]
    ratings = spark.createDataFrame([(i % 50, i % 30, 1.0) for i in range(500)], "uid int, mid int, score double")
    rows, per_model = scoring._dealt(models, ratings, F.lit(0), scoring.BLOCK_DOUBLES, (3, 2))
    held = rows.groupBy(F.spark_partition_id().alias("p")).agg(F.count_distinct("_g").alias("g")).collect()
    assert per_model == 6 and len(held) == 12 and all(r["g"] == 1 for r in held)
    # Spark's Arrow writer takes time with the square of a batch for nulls of a list column
    assert rows.where("_f is null").count() == 0


def test_chunks_gathered_as_rows_pass(spark):
    rng = np.random.default_rng(2)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.standard_normal((400, 4)))], "mid int, features array<float>")
    ranked = online.ranked_edges(similarity_table(vectors))
    assert ranked.where("chunk > 1").count()
    got = similarity.similar_list_chunks(ranked, in_order=True)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[:plan.rindex("MapInArrow")]  # no row of the table is shuffled
    plain = lambda df: sorted((r["mid"], r["chunk"], [tuple(x) for x in r["recs"]]) for r in df.collect())
    want = plain(similarity.similar_list_chunks(ranked))
    assert plain(got) == want
    for size in (7, 1000):  # lists go on in the next batch
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(size))
        try:
            assert plain(similarity.similar_list_chunks(ranked, in_order=True)) == want
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def similarity_table(vectors):
    from cinerank.operators.lookup import SimilarityTable

    return SimilarityTable(vectors, 0.2, 6)
