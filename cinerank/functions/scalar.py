"""Column helpers: list split, trim, numeric conversion, month key, rounding, log2, cosine."""

from __future__ import annotations

import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def split_list(x: ColumnOrName, sep: str = "|") -> Column:
    """Split on a literal separator, dropping trailing empty parts like Java's ``String.split``.

    ``'a|b||'`` gives ``[a, b]``; ``''`` gives ``['']``.  (Only ``'||'`` differs from Java:
    Java gives ``[]``, this gives ``['']``.)  Null stays null.
    """
    s = re.escape(sep)
    return F.split(F.regexp_replace(_c(x), f"(?:{s})+$", ""), s)


def java_trim(x: ColumnOrName) -> Column:
    """Trim every character <= U+0020 at both ends (Java ``String.trim``), not only blanks."""
    return F.regexp_replace(_c(x), r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def to_number(x: ColumnOrName, dtype: T.DataType | str, lenient: bool = False) -> Column:
    """Text to a number: bad text fails the job, whether or not the session is ANSI; ``lenient`` gives null."""
    c = _c(x)
    if lenient:
        return c.try_cast(dtype)
    return F.when(c.isNotNull(), F.coalesce(c.try_cast(dtype), F.raise_error(F.concat(F.lit("not a number: "), c)).cast(dtype)))


def epoch_seconds(ts: ColumnOrName) -> Column:
    """Whole epoch seconds (floor) of a TIMESTAMP_NTZ, independent of the session zone."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), _c(ts))


def year_month(seconds: ColumnOrName, tz: str = "UTC") -> Column:
    """Epoch seconds to the integer ``yyyyMM`` of the wall clock in zone ``tz``.

    UTC is computed from whole days (``date_from_unix_date``), so it does not depend on
    the session zone; other zones shift the instant first.
    """
    s = _c(seconds).cast("long")
    if tz.upper() == "UTC":
        d = F.date_from_unix_date(F.floor(s / 86400).cast("int"))
    else:
        local = F.from_utc_timestamp(F.timestamp_seconds(s), tz)
        d = F.to_date(F.date_format(local, "yyyy-MM-dd"))
    return (F.year(d) * 100 + F.month(d)).cast("int")


def half_up(x: ColumnOrName, scale: int = 2) -> Column:
    """Round half up on the decimal text of a double (``2.675`` -> ``2.68``, ``1.005`` -> ``1.01``)."""
    return F.round(_c(x), scale)


def log2_count(n: ColumnOrName) -> Column:
    """log2 of a count whose missing/zero value counts as 1, so an absent counter adds 0."""
    return F.log2(F.greatest(F.coalesce(_c(n).cast("double"), F.lit(1.0)), F.lit(1.0)))


def cosine(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Cosine of two numeric arrays with higher-order functions (double precision).

    Zero vectors give NaN, so a ``> t`` filter must also exclude NaN.
    """
    a, b = _c(a), _c(b)
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)
    na = F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))
    nb = F.sqrt(F.aggregate(b, F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))
    return F.try_divide(dot, na * nb)


def register_sql_functions(spark: SparkSession) -> None:
    """Register the reference's three SQL helpers as SQL functions that Catalyst inlines.

    ``changeDate(ts)`` -> ``yyyyMM`` (UTC), ``halfUp(x, scale)``, ``splitGe(genres)``.
    """
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION changeDate(ts BIGINT) RETURNS INT RETURN "
        "CAST(year(date_from_unix_date(CAST(floor(ts / 86400) AS INT))) * 100 + "
        "month(date_from_unix_date(CAST(floor(ts / 86400) AS INT))) AS INT)"
    )
    # round() needs a constant scale: one branch per scale, folded when the call passes a literal
    branches = " ".join(f"WHEN {i} THEN round(x, {i})" for i in range(10))
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION halfUp(x DOUBLE, scale INT) RETURNS DOUBLE RETURN CASE scale {branches} END")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION splitGe(g STRING) RETURNS ARRAY<STRING> "
        "RETURN split(regexp_replace(g, '[|]+$', ''), '[|]')"
    )
