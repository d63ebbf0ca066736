"""Ranking primitives: top-n per group, a distributed global row number and a distributed row number per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinerank.session import materialize


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, out: str = "rank") -> DataFrame:
    """``row_number() over (partition by keys order by order) <= n``.

    Spark plans this as a ``WindowGroupLimit`` on both sides of the shuffle, so each map
    task forwards at most ``n`` rows per key: a key holding a third of all rows costs the
    same shuffle as any other.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w)).where(F.col(out) <= n)


def global_row_number(df: DataFrame, order: Sequence[Column], out: str = "rank", partitions: int | None = None) -> DataFrame:
    """Row numbers 1..N over the whole input in ``order`` without a single-task window.

    The input is range-partitioned on the order (a distributed sort), each row tagged with
    its range partition and written once to the shared folder, so the partition of a row
    cannot change between the two uses below.  The per-partition counts (one row per
    partition, so bounded by ``partitions``) give each range its offset; the rows are then
    numbered inside their range by a window partitioned by range.
    """
    # without an explicit count AQE may coalesce adjacent ranges, which keeps them ordered
    parted = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    ranged = materialize(parted.withColumn("_pid", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = Window.partitionBy("_pid").orderBy(*order)
    return (
        ranged.join(F.broadcast(offsets), "_pid")
        .withColumn(out, (F.col("_off") + F.row_number().over(local)).cast("int"))
        .drop("_pid", "_off")
    )


def row_number_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str = "rank", partitions: int | None = None) -> DataFrame:
    """``row_number() over (partition by keys order by order)`` without a task for all rows of a key.

    Rows are range-partitioned on keys and order, so the rows of a hot key lie in several consecutive ranges, and written
    once with their range.  Rows are numbered inside (range, key); a range adds the counts of the same key in the ranges
    before it, an aggregate of at most one row for each key and range that holds it.
    """
    by = [F.col(k) for k in keys]
    parted = df.repartitionByRange(partitions, *by, *order) if partitions else df.repartitionByRange(*by, *order)
    ranged = materialize(parted.withColumn("_pid", F.spark_partition_id()), "ranged-keys")
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("_pid", *keys).agg(F.count(F.lit(1)).alias("_n"))
    # only keys that go on from an earlier range need an offset: at most one for each range
    offsets = counts.withColumn("_off", F.sum("_n").over(before)).where(F.col("_off") > 0).drop("_n")
    local = ranged.withColumn("_rn", F.row_number().over(Window.partitionBy("_pid", *keys).orderBy(*order)))
    return (
        local.join(offsets, ["_pid", *keys], "left")
        .withColumn(out, (F.coalesce("_off", F.lit(0)) + F.col("_rn")).cast("int"))
        .drop("_pid", "_off", "_rn")
    )
