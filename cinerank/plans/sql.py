"""The statistics as SQL text over named views, for users who run SQL statements.

``register(spark, ratings=..., movies=...)`` creates the views and the SQL functions
``changeDate`` (epoch seconds -> yyyyMM), ``halfUp(x, scale)`` and ``splitGe(genres)``.
Each statement is planned by Catalyst exactly like the DataFrame operators in
``operators/stats.py``: the functions are SQL functions, inlined into the plan.  (A SQL
function may not appear inside a generator, so ``splitGe`` is projected before the
``explode``.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank.functions.scalar import register_sql_functions
from cinerank.operators.ranking import global_row_number

STATEMENTS = {
    "rating_counts": "SELECT mid, count(mid) AS count FROM ratings GROUP BY mid",
    "monthly_rating_counts": """
        SELECT mid, count(mid) AS count, yearmonth
        FROM (SELECT mid, changeDate(timestamp) AS yearmonth FROM ratings) AS by_month
        GROUP BY yearmonth, mid""",
    "average_scores": "SELECT mid, halfUp(avg(score), 2) AS avgscore FROM ratings GROUP BY mid",
    "genre_top10": """
        WITH scored AS (
          SELECT m.mid, a.avgscore, splitGe(m.genres) AS genre_list
          FROM movies m
          JOIN (SELECT mid, halfUp(avg(score), 2) AS avgscore FROM ratings GROUP BY mid) a ON m.mid = a.mid),
        per_genre AS (
          SELECT mid, avgscore, g.gen FROM scored LATERAL VIEW explode(genre_list) g AS gen),
        ranked AS (
          SELECT mid, gen, avgscore, row_number() OVER (PARTITION BY gen ORDER BY avgscore DESC, mid) AS rank
          FROM per_genre)
        SELECT mid, gen, avgscore, rank FROM ranked WHERE rank <= 10""",
    "high_quality": """
        SELECT mid, halfUp(mean, 2) AS avg, n AS count, mean
        FROM (SELECT mid, avg(score) AS mean, count(*) AS n FROM ratings GROUP BY mid)
        WHERE mean > 3.5 AND n > 50""",
    "recent_top10": """
        SELECT mid, count(*) AS count FROM ratings
        WHERE timestamp > (SELECT max(timestamp) - 7776000 FROM ratings)
        GROUP BY mid ORDER BY count DESC, mid LIMIT 10""",
}


def register(spark: SparkSession, **views: DataFrame) -> None:
    """Create (or replace) the named views and the SQL functions."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    register_sql_functions(spark)


def run(spark: SparkSession, name: str) -> DataFrame:
    """Run one of the statements over the registered views.

    ``high_quality`` gets its ``rank`` by a distributed row number: in SQL a window without partitions runs in one task.
    """
    out = spark.sql(STATEMENTS[name])
    if name == "high_quality":
        order = [F.desc("mean"), F.desc("count"), F.asc("mid")]
        return global_row_number(out, order).select("mid", "avg", "count", "rank")
    return out
