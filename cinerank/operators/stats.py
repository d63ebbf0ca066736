"""Rating statistics: counts, monthly counts, averages, per-genre top n, high quality, recent top n.

All are declarative aggregations; Spark runs each with a map-side partial aggregate, so a
hot item is pre-combined in every task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.functions.recs import recs_array
from cinerank.functions.scalar import half_up, split_list, year_month
from cinerank.operators.ranking import global_row_number, top_n_per_group

NINETY_DAYS = 7776000  # seconds


def rating_counts(ratings: DataFrame) -> DataFrame:
    """Number of ratings per item: ``mid, count`` (a null mid group counts 0, as ``COUNT(mid)``)."""
    return ratings.groupBy("mid").agg(F.count("mid").alias("count"))


def monthly_rating_counts(ratings: DataFrame, tz: str = "UTC") -> DataFrame:
    """Ratings per (month, item): ``mid, count, yearmonth`` with ``yearmonth = yyyyMM`` in zone ``tz``."""
    return (
        ratings.select("mid", year_month("timestamp", tz).alias("yearmonth"))
        .groupBy("yearmonth", "mid")
        .agg(F.count("mid").alias("count"))
        .select("mid", "count", "yearmonth")
    )


def average_scores(ratings: DataFrame, scale: int = 2) -> DataFrame:
    """Average score per item, rounded half up: ``mid, avgscore``."""
    return ratings.groupBy("mid").agg(half_up(F.avg("score"), scale).alias("avgscore"))


def genre_top_n(movies: DataFrame, averages: DataFrame, n: int = 10, nested: bool = False) -> DataFrame:
    """Best ``n`` items per genre by average score (ties: smaller mid first).

    Items without an average are left out (inner join); a null genre list gives no row.
    Flat form: ``mid, gen, avgscore, rank``.  Nested form: ``gen, recs`` with
    ``recs = array<struct<rid, r>>`` in rank order.
    """
    joined = movies.select("mid", "genres").join(averages.select("mid", "avgscore"), "mid")
    per_genre = joined.select("mid", "avgscore", F.explode(split_list("genres")).alias("gen"))
    ranked = top_n_per_group(per_genre, ["gen"], [F.desc("avgscore"), F.asc("mid")], n)
    if nested:
        return recs_array(ranked, "gen", "mid", "avgscore", "rank")
    return ranked.select("mid", "gen", "avgscore", F.col("rank").cast("int").alias("rank"))


def high_quality(ratings: DataFrame, min_avg: float = 3.5, min_count: int = 50, scale: int = 2) -> DataFrame:
    """Items with average > ``min_avg`` and more than ``min_count`` ratings, ranked.

    The thresholds and the ranking use the unrounded average; the output average is rounded.
    Order: average desc, count desc, mid asc.  Output ``mid, avg, count, rank``.
    """
    agg = (
        ratings.groupBy("mid")
        .agg(F.avg("score").alias("_avg"), F.count(F.lit(1)).alias("count"))
        .where((F.col("_avg") > F.lit(min_avg)) & (F.col("count") > F.lit(min_count)))
    )
    ranked = global_row_number(agg, [F.desc("_avg"), F.desc("count"), F.asc("mid")])
    return ranked.select("mid", half_up("_avg", scale).alias("avg"), "count", "rank")


def recent_top_n(ratings: DataFrame, n: int = 10, window_seconds: int = NINETY_DAYS) -> DataFrame:
    """Most rated items among ratings newer than ``max(timestamp) - window_seconds`` (strict).

    The bound is an uncorrelated scalar subquery, so Spark computes it once and pushes it
    into the scan filter.  Output ``mid, count``; ties: smaller mid first.
    """
    bound = ratings.select((F.max("timestamp") - F.lit(window_seconds)).alias("_b")).scalar()
    return (
        ratings.where(F.col("timestamp") > bound)
        .groupBy("mid")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc("mid"))
        .limit(n)
    )
