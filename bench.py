"""Benchmark: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS] and print one JSON line.

Each query is executed in full by writing it to the ``noop`` sink (no collect to the driver).
``BENCH_QUERIES`` (comma separated) selects a subset.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from cinerank.operators import model  # noqa: E402
from cinerank.plans.queries import QUERIES  # noqa: E402
from cinerank.session import get_session  # noqa: E402
from cinerank.sources import fixtures as fx  # noqa: E402

HEADLINE = [
    "rating_counts", "monthly_rating_counts", "average_scores", "genre_top10", "high_quality_items", "recent_top10",
    "items_with_tags", "text_load_ratings", "similar_pairs", "candidates", "rerank", "merged_recs", "stream_recs",
    "als_fit", "als_user_recs", "als_rmse",
]


def als_fit(spark, d):
    """ALS rank 50, 5 iterations, λ 0.01 (the training step alone)."""
    m = model.train_als(fx.ratings(spark, d), seed=42)
    return m.itemFactors


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    conf = {
        "spark.sql.shuffle.partitions": str(int(cpus) * 2),
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "24g"),
        "spark.eventLog.enabled": "false",
    }
    # the shared folder comes from spark.checkpoint.dir; get_session sets a temporary one only if unset
    spark = get_session(f"local[{cpus}]", app="cinerank-bench", conf=conf)
    qs = dict(QUERIES, als_fit=als_fit)
    # warm the JVM and the Python workers once (not timed)
    fx.ratings(spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.range(64).withColumn("k", F.col("id") % 8).groupBy("k").applyInPandas(lambda p: p, "id long, k long") \
        .write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
