"""Scale properties of the physical plans (checked on the plan, not on timings)."""

import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from cinerank.operators import model, online, similarity, stats
from cinerank.session import materialize
from cinerank.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def plan(df):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_top_n_per_group_limits_both_sides_of_the_shuffle(spark):
    p = plan(stats.genre_top_n(fx.movies(spark, SF), stats.average_scores(fx.ratings(spark, SF)), 10))
    assert p.count("WindowGroupLimit") >= 4  # operator tree + details, before and after the exchange


def test_global_top_k_is_take_ordered(spark):
    p = plan(stats.recent_top_n(fx.ratings(spark, SF)))
    assert "TakeOrderedAndProject" in p and "Window" not in p


def test_scans_read_only_needed_columns(spark):
    p = plan(stats.rating_counts(fx.ratings(spark, SF)))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in p
    assert "ReadSchema: struct<o_orderkey:bigint>" in p


def test_written_key_set_gives_broadcast_semi_join(spark):
    big = fx.event_ratings(spark, SF)
    keys = materialize(big.select("uid").distinct().limit(5), "plan-keys")
    p = plan(online.restrict(big, keys, ["uid"]))
    assert "BroadcastHashJoin LeftSemi" in p


def test_blocked_kernels_plan_no_cross_join(spark):
    v = fx.item_vectors(spark, SF)
    p1 = plan(similarity.similar_pairs(v, 0.5))
    users = v.select(F.col("mid").alias("uid"), "features")
    p2 = plan(model.blocked_top_k(users, v, 5))
    for p in (p1, p2):
        assert "FlatMapGroupsInPandas" in p
        assert "CartesianProduct" not in p and "NestedLoopJoin" not in p


def test_global_rank_has_no_window_over_all_rows(spark):
    p = plan(stats.high_quality(fx.ratings(spark, SF), 3.0, 1))
    # rows are numbered inside their range partition; the one single-partition exchange
    # only carries the per-range counts (one row per range) for the offsets
    assert p.count("Arguments: hashpartitioning(_pid") == 2  # per-range counts, per-range numbering
    assert p.count("Arguments: SinglePartition") == 1  # the offsets over the per-range counts


def test_bucketed_layout_reads_only_the_key_sets_buckets(spark, tmp_dir):
    from cinerank.sinks import write_layout

    er = fx.event_ratings(spark, SF)
    path = f"{tmp_dir}/ratings_bucketed"
    write_layout(er, path, "uid", partitions=4, buckets=16, tie=["mid"])
    stored = spark.read.parquet(path)
    assert "_uid_b16" in stored.columns
    keys = materialize(er.select("uid").distinct().limit(3), "bucket-keys")
    r = online.restrict(stored, keys, ["uid"])
    p = plan(r)
    scan = [line for line in p.splitlines() if line.startswith("PartitionFilters")]
    assert any("_uid_b16" in line and " IN (" in line for line in scan)
    plain = online.restrict(er, keys, ["uid"])
    assert sorted(map(tuple, r.drop("_uid_b16").collect())) == sorted(map(tuple, plain.collect()))
