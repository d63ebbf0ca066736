"""Whole jobs: each reads its inputs once and writes every table it produces.

These are what a user of the reference runs: the loader, the statistics job (six
tables), the offline job (per-user lists and similar-item lists), the tuning job and the
streaming job.  Each is a short composition of the operators and sinks; outputs are
full-refresh writes under ``out_dir/<table>``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cinerank import sinks
from cinerank.functions.recs import pack_recs
from cinerank.operators import catalogue, model, stats
from cinerank.operators.similarity import similar_lists
from cinerank.session import materialize
from cinerank.sources import text as text_src


def _out(out_dir: str, name: str) -> str:
    return f"{out_dir.rstrip('/')}/{name}"


def load_job(
    spark: SparkSession,
    movies_path: str,
    ratings_path: str,
    tags_path: str,
    out_dir: str,
    lenient: bool = False,
    export_path: str | None = None,
    rating_buckets: int | None = None,
) -> dict[str, str]:
    """Text files -> Movie / Rating / Tag tables (laid out by mid / uid) and the search documents.

    ``rating_buckets`` partitions the ratings by a hash bucket of uid as well, the layout the
    online operators prune per micro-batch (see ``operators.online.restrict``).
    """
    movies = text_src.load_movies_text(spark, movies_path, lenient)
    ratings = text_src.load_ratings_text(spark, ratings_path, lenient)
    tags = text_src.load_tags_text(spark, tags_path, lenient)
    paths = {n: _out(out_dir, n) for n in ("movies", "ratings", "tags")}
    sinks.write_layout(movies, paths["movies"], "mid")
    sinks.write_layout(ratings, paths["ratings"], "uid", buckets=rating_buckets, tie=["mid"])
    sinks.write_layout(tags, paths["tags"], "mid")
    docs = catalogue.movies_with_tags(spark.read.parquet(paths["movies"]), spark.read.parquet(paths["tags"]))
    paths["documents"] = export_path or _out(out_dir, "documents")
    sinks.export_documents(docs, paths["documents"])
    return paths


def statistics_job(
    ratings: DataFrame,
    movies: DataFrame,
    out_dir: str,
    n: int = 10,
    min_avg: float = 3.5,
    min_count: int = 50,
    write_input: bool = False,
) -> dict[str, str]:
    """The six statistics tables.

    A stored ratings table is scanned by each statistic with only the columns it needs.
    ``write_input=True`` first writes a derived (expensive) ratings plan once, so it is not
    recomputed six times.  The per-item averages (one row per item) are written once and
    shared by two tables.
    """
    r = ratings.select("uid", "mid", "score", "timestamp")
    if write_input:
        r = materialize(r, "stats-ratings")
    averages = materialize(stats.average_scores(r), "stats-averages")
    tables = {
        "rate_more": stats.rating_counts(r),
        "rate_more_recently": stats.monthly_rating_counts(r),
        "average": averages,
        "genres_top": stats.genre_top_n(movies, averages, n),
        "high_quality": stats.high_quality(r, min_avg, min_count),
        "recent_top": stats.recent_top_n(r, n),
    }
    paths = {}
    for name, df in tables.items():
        paths[name] = _out(out_dir, name)
        sinks.write_table(df, paths[name])
    return paths


def offline_job(
    ratings: DataFrame,
    movies: DataFrame,
    out_dir: str,
    n: int = 20,
    threshold: float = 0.6,
    seed: int = 42,
    write_input: bool = False,
) -> dict[str, str]:
    """ALS -> per-user top-n lists and item-item similarity (flat edges and lists).

    ``write_input=True`` writes a derived ratings plan once before the model reads it twice.
    """
    r = ratings.select("uid", "mid", "score")
    if write_input:
        r = materialize(r, "offline-ratings")
    m = model.train_als(r, seed=seed)
    paths = {n_: _out(out_dir, n_) for n_ in ("user_recs", "item_edges", "item_recs")}
    sinks.write_table(model.user_recommendations(m, r, movies, n), paths["user_recs"])
    sinks.write_table(model.item_similarity(m, threshold), paths["item_edges"])
    edges = ratings.sparkSession.read.parquet(paths["item_edges"])
    sinks.write_table(similar_lists(edges), paths["item_recs"])
    return paths


def tuning_job(ratings: DataFrame, parallelism: int = 1, holdout: float | None = None) -> DataFrame:
    """The 15-model grid (ranks 30..70 x λ 1, 0.1, 0.001), best first."""
    return model.tune_als(ratings, holdout=holdout, parallelism=parallelism)


def packed(user_recs: DataFrame) -> DataFrame:
    """Nested per-user lists in the packed text form ``rid:r|rid:r``."""
    return user_recs.select("uid", pack_recs("recs").alias("recs"))
