"""Recommendation lists: nested ``array<struct<rid int, r double>>`` and the packed text form.

Packed text is ``rid:r|rid:r`` with ``r`` printed as Spark prints a double.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pack_recs(recs: ColumnOrName) -> Column:
    """``array<struct<rid, r>>`` -> ``'rid:r|rid:r'``; an empty list gives ``''``."""
    return F.array_join(
        F.transform(_c(recs), lambda x: F.concat_ws(":", x["rid"].cast("string"), x["r"].cast("string"))), "|"
    )


def unpack_recs(text: ColumnOrName) -> Column:
    """``'rid:r|rid:r'`` -> ``array<struct<rid int, r double>>``; ``''`` gives an empty list."""
    parts = F.filter(F.split(_c(text), r"\|"), lambda s: s != "")
    return F.transform(
        parts,
        lambda s: F.struct(
            F.split(s, ":")[0].cast("int").alias("rid"),
            F.split(s, ":")[1].cast("double").alias("r"),
        ),
    )


def recs_array(df: DataFrame, key: str, rid: str, r: str, rank: str, out: str = "recs") -> DataFrame:
    """Group ranked rows into one ordered list per key (``rank`` ascending).

    Callers cut the rank first (``rank <= k``), so a list holds at most k entries and no
    group grows with the input.
    """
    return (
        df.groupBy(key)
        .agg(F.array_sort(F.collect_list(F.struct(F.col(rank).alias("_k"), F.col(rid).alias("rid"), F.col(r).alias("r")))).alias("_l"))
        .select(key, F.transform("_l", lambda x: F.struct(x["rid"].cast("int").alias("rid"), x["r"].cast("double").alias("r"))).alias(out))
    )


def edges_of_lists(lists: DataFrame, key: str = "mid", recs: str = "recs") -> DataFrame:
    """Nested lists (``mid, recs array<struct<rid, r>>``) as rows ``mid, rid, r``.

    An item that a list names twice keeps its last value; of several lists of one key the later place in its list wins,
    then the larger value.  Null lists, empty lists and null elements have no rows.
    """
    each = lists.select(key, F.posexplode(recs).alias("_p", "_x")).where("_x is not null")
    last = each.groupBy(key, F.col("_x.rid").alias("rid")).agg(F.max(F.struct("_p", F.col("_x.r").alias("r"))).alias("_l"))
    return last.select(key, "rid", F.col("_l.r").alias("r"))
