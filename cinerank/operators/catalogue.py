"""Catalogue enrichment: items with their tag list, and the search-document export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.operators.ranking import row_number_per_key


def tag_lists(tags: DataFrame, sep: str = "|") -> DataFrame:
    """Distinct tags per item joined in sorted order: ``mid, tags`` (all-null tags give ``''``).

    ``collect_set`` is partially aggregated in each task, so a hot item ships one set per
    task, not one row per tag event.
    """
    return tags.groupBy("mid").agg(F.array_join(F.array_sort(F.collect_set("tag")), sep).alias("tags"))


def movies_with_tags(movies: DataFrame, tags: DataFrame, sep: str = "|") -> DataFrame:
    """Every catalogue item with its tag list (null when the item has no tag)."""
    return movies.join(tag_lists(tags, sep), "mid", "left")


def tag_chunks(tags: DataFrame, size: int = 1000, sep: str = "|") -> DataFrame:
    """The distinct tags of each item in order, in rows of at most ``size``: ``mid, part, n_tags, tags``.

    Distinct (item, tag) rows are numbered in order by range partitions (``row_number_per_key``), so no task and no row
    holds all tags of a hot item; joined in the order of ``part`` the rows give ``tag_lists``.
    """
    each = tags.where("tag is not null").select("mid", "tag").distinct()
    placed = row_number_per_key(each, ["mid"], [F.asc("tag")], "_rank")
    chunk = placed.withColumn("part", F.floor((F.col("_rank") - 1) / size).cast("int"))
    return chunk.groupBy("mid", "part").agg(
        F.count(F.lit(1)).cast("int").alias("n_tags"), F.array_join(F.array_sort(F.collect_list("tag")), sep).alias("tags"))


def user_item_pair_counts(ratings: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Size of each user's slice of users x catalogue: ``uid, n_pairs``.

    The reference forms the product of distinct users and catalogue ids before scoring;
    the product itself is never needed as rows (scoring is blocked, see
    ``model.user_recommendations``).  Its per-user size is the catalogue row count, taken
    by a scalar subquery, so nothing quadratic is planned.
    """
    n_items = catalogue.select(F.count(F.lit(1))).scalar()
    return ratings.select("uid").distinct().select("uid", n_items.alias("n_pairs"))
