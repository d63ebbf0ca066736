"""Views of the reference's inputs over the driver's tables (see FIXTURES.md §3).

Each view is a lazy projection of a parquet scan, so column pruning and filters reach
the files.  The same definitions are written as DuckDB SQL in ``plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank.functions.scalar import epoch_seconds


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ orders: uid=o_custkey, mid=l_partkey, score=ceil(l_quantity/10), timestamp=epoch s of o_orderdate."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").cast("int").alias("uid"),
        F.col("l_partkey").cast("int").alias("mid"),
        F.ceil(F.col("l_quantity") / 10).cast("double").alias("score"),
        epoch_seconds("o_orderdate").cast("int").alias("timestamp"),
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part: mid=p_partkey, name=p_name, genres = p_type | words of p_name."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("mid"),
        F.col("p_name").alias("name"),
        F.concat_ws("|", F.col("p_type"), F.regexp_replace("p_name", " ", "|")).alias("genres"),
    )


def movies_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``movies`` widened to the 10-field Movie record (text fields derived from part)."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("mid"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("A "), F.col("p_name"), F.lit(" of brand "), F.col("p_brand")).alias("descri"),
        F.concat(F.col("p_size").cast("string"), F.lit(" minutes")).alias("timelong"),
        F.concat(F.lit("size "), F.col("p_size").cast("string")).alias("issue"),
        (F.lit(1950) + F.col("p_size")).cast("string").alias("shoot"),
        F.substring("p_type", 1, 4).alias("language"),
        F.concat_ws("|", F.col("p_type"), F.regexp_replace("p_name", " ", "|")).alias("genres"),
        F.regexp_replace("p_name", " ", "|").alias("actors"),
        F.col("p_brand").alias("directors"),
    )


def _event_mid() -> F.Column:
    return F.get_json_object("props", "$.k").cast("int")


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events: uid=user_id, mid=props.k, tag=event_type, timestamp=epoch s of ts."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("int").alias("uid"),
        _event_mid().alias("mid"),
        F.col("event_type").alias("tag"),
        epoch_seconds("ts").cast("int").alias("timestamp"),
    )


def event_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as ratings: score = least(5, greatest(0.5, ceil(value/10)/2))."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("int").alias("uid"),
        _event_mid().alias("mid"),
        F.least(F.lit(5.0), F.greatest(F.lit(0.5), F.ceil(F.col("value") / 10) / 2)).cast("double").alias("score"),
        epoch_seconds("ts").cast("int").alias("timestamp"),
    )


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings: mid=vec_id, features=embedding."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("int").alias("mid"), F.col("embedding").alias("features")
    )
