"""Table writers.

``mode("overwrite")`` replaces the target as a whole (the reference drops a collection and
writes it again).  The keyed sink for the stream writes one partition per micro-batch id
with dynamic partition overwrite, so replaying a batch rewrites only that batch's files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank.operators.ranking import top_n_per_group


def write_table(df: DataFrame, path: str | None = None, fmt: str = "parquet", mode: str = "overwrite", **options: str) -> None:
    """Full-refresh write through any data source (a connector is a ``fmt`` plus ``options``)."""
    w = df.write.mode(mode).format(fmt).options(**options)
    w.save(path) if path is not None else w.save()


def bucket_column(key: str, buckets: int) -> str:
    """Name of the hash-bucket partition column of ``key``; it records the bucket count."""
    return f"_{key}_b{buckets}"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def write_layout(
    df: DataFrame,
    path: str,
    key: str,
    partitions: int | None = None,
    fmt: str = "parquet",
    buckets: int | None = None,
    tie: list[str] | None = None,
) -> None:
    """Write range-partitioned and sorted on ``key`` so each file covers a narrow key range.

    Parquet keeps min/max per row group, so a later filter or join on ``key`` skips most
    files: the access path the reference gets from an index on uid / mid.

    With ``buckets`` the table is also partitioned by a hash bucket of ``key`` (column
    ``bucket_column(key, buckets)``): a semi-join with a broadcast key set (``restrict``)
    then prunes whole bucket folders at run time (dynamic partition pruning), so a batch
    of users reads only their buckets.  ``tie`` columns extend the range order so that a
    key holding many rows is split over several files.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    w = df
    order = [key] + list(tie or [])
    if buckets:
        bc = bucket_column(key, buckets)
        w = w.withColumn(bc, bucket_of(key, buckets))
        order = [bc] + order
    w = w.repartitionByRange(n, *order).sortWithinPartitions(*order).write.mode("overwrite").format(fmt)
    if buckets:
        w = w.partitionBy(bucket_column(key, buckets))
    w.save(path)


#: Bits of each key in the order of a clustered table.
CLUSTER_BITS = 16


def interleaved(*keys: Column) -> Column:
    """The bits of whole numbers of ``CLUSTER_BITS`` bits dealt in turn into one, so near keys in all of them are near."""
    out = F.lit(0).cast("long")
    for bit in range(CLUSTER_BITS):
        for place, k in enumerate(keys):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(k.cast("long"), bit).bitwiseAND(F.lit(1).cast("long")), bit * len(keys) + place))
    return out


def write_clustered(df: DataFrame, path: str, keys: list[str], files: int) -> None:
    """Write ``files`` files so that a lookup by any of ``keys`` (numbers) can skip most: about ``files ** (1 - 1 / len(keys))``
    of them cover a value.

    Rows are ordered by the interleaved bits of the keys' places among their quantiles, so hot ranges of a key do not crowd
    the order; Parquet keeps the least and largest value of each key.  Null keys lie first.
    """
    steps = 1 << CLUSTER_BITS
    shares = [i / 64 for i in range(65)]
    bounds = df.select(*(F.percentile_approx(k, F.lit(shares), 10_000).alias(k) for k in keys)).first()
    places = []
    for k in keys:
        edges = sorted(set(bounds[k] or [0]))
        least, scale = edges[0], len(edges)
        # the quantile a key lies in, and how far between its bounds: at most 65 constants a key
        slot = F.lit(0.0)
        if scale > 1:
            cuts = F.array(*(F.lit(float(e)) for e in edges))
            at = F.greatest(F.lit(1), F.least(F.lit(scale - 1), F.size(F.filter(cuts, lambda e: e <= F.col(k).cast("double")))))
            low, high = F.get(cuts, at - 1), F.get(cuts, at)
            inside = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col(k) - low) / (high - low)))
            slot = (at - 1 + inside) / (scale - 1) * (steps - 1)
        places.append(F.coalesce(F.floor(slot), F.lit(0)))
    placed = df.withColumn("_z", interleaved(*places))
    placed.repartitionByRange(files, "_z").sortWithinPartitions("_z").drop("_z").write.mode("overwrite").parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> None:
    """Save as a catalog table bucketed and sorted on ``key``: joins on ``key`` between tables
    with the same bucket count need no shuffle."""
    w = df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet")
    if path is not None:
        w = w.option("path", path)
    w.saveAsTable(table)


def export_documents(df: DataFrame, path: str, id_col: str = "mid", fmt: str = "json", **options: str) -> None:
    """Search-document export: one document per id (``_id``), replacing the previous export.

    The reference indexes rows with the id as document id, so the last write per id wins;
    here one row per id is kept before writing.  A search connector is a ``fmt`` plus options.
    """
    docs = df.dropDuplicates([id_col]).withColumn("_id", F.col(id_col))
    docs.write.mode("overwrite").format(fmt).options(**options).save(path)


#: Ids of snapshots: this plus the newest batch they hold; below every batch id.
SNAPSHOTS = -(1 << 62)


def write_keyed_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Append the rows of one micro-batch under ``batch_id=<id>``; a replay of the same id
    overwrites only that partition (idempotent)."""
    (
        df.withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def read_keyed_latest(spark: SparkSession, path: str, key: str = "uid", schema: str | None = None) -> DataFrame:
    """The newest row per key over all written batches (the current state of the keyed table)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    rows = r.parquet(path)
    return top_n_per_group(rows, [key], [F.desc("batch_id")], 1, "_pos").drop("_pos", "batch_id")


def compact_keyed(spark: SparkSession, path: str, key: str = "uid") -> int:
    """Fold the batches before the newest one into a snapshot partition; returns the newest batch id.

    The newest batch may be replayed, so it is left as it is: a replay rewrites only its own
    partition, which holds nothing but its own rows.  The snapshot is a partition of its own
    (an id below all batches, higher for later snapshots), written before the partitions it
    replaces are removed.  A reader that has listed files which then go fails: run it while
    nobody reads, or keep the table as ``versioned.VersionedTable``, which needs no compaction.
    """
    from cinerank.session import remove_path

    rows = spark.read.parquet(path)
    newest = int(rows.agg(F.max("batch_id").alias("m")).first()["m"])
    closed = rows.where(F.col("batch_id") < newest)
    folded = closed.agg(F.max("batch_id").alias("m")).first()["m"]
    if folded is None or folded < 0:
        return newest
    snapshot = SNAPSHOTS + int(folded)
    write_keyed_batch(top_n_per_group(closed, [key], [F.desc("batch_id")], 1, "_pos").drop("_pos", "batch_id"), path, snapshot)
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("batch_id=") and int(name.split("=", 1)[1]) < newest and name != f"batch_id={snapshot}":
            remove_path(spark, st.getPath().toString())
    return newest
