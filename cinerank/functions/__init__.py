"""Scalar functions of the data model as JVM-side Column expressions.

None of these is a Python UDF: Catalyst sees through each of them, so filters on their
results can still be pushed down and whole-stage codegen stays intact.
"""

from cinerank.functions.scalar import (
    cosine,
    epoch_seconds,
    half_up,
    java_trim,
    log2_count,
    register_sql_functions,
    split_list,
    to_number,
    year_month,
)
from cinerank.functions.recs import pack_recs, recs_array, unpack_recs

__all__ = [
    "cosine", "epoch_seconds", "half_up", "java_trim", "log2_count", "register_sql_functions",
    "split_list", "to_number", "year_month", "pack_recs", "recs_array", "unpack_recs",
]
