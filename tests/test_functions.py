import math

from pyspark.sql import functions as F

from cinerank.functions import (
    cosine, half_up, java_trim, log2_count, pack_recs, register_sql_functions, split_list, unpack_recs, year_month,
)


def one(spark, col, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_split_list_drops_trailing_empties(spark):
    got = one(spark, split_list("g"), [("a|b||",), ("",), ("Action",), (None,), ("Action|Drama||",)], "g string")
    assert got == [["a", "b"], [""], ["Action"], None, ["Action", "Drama"]]


def test_java_trim_trims_control_characters(spark):
    assert one(spark, java_trim("s"), [("\t x \n",), (" y",)], "s string") == ["x", "y"]


def test_half_up_on_decimal_text(spark):
    assert one(spark, half_up("x", 2), [(1.005,), (2.675,), (3.4285714285714284,)], "x double") == [1.01, 2.68, 3.43]


def test_year_month_utc_around_midnight(spark):
    # 2009-12-31 23:59:59 and 2010-01-01 00:00:00 UTC
    got = one(spark, year_month("t"), [(1262303999,), (1262304000,), (1261000000,)], "t int")
    assert got == [200912, 201001, 200912]


def test_year_month_other_zone(spark):
    # 2010-01-01 00:00:00 UTC is still December in New York
    assert one(spark, year_month("t", "America/New_York"), [(1262304000,)], "t int") == [200912]


def test_log2_count_missing_counts_one(spark):
    got = one(spark, log2_count("n"), [(None,), (0,), (1,), (4,)], "n int")
    assert got == [0.0, 0.0, 0.0, 2.0]


def test_pack_and_unpack(spark):
    df = spark.createDataFrame([(1, [(22, 4.5), (45, 3.8)]), (2, []), (3, [(7, 1.0)])], "uid int, recs array<struct<rid:int,r:double>>")
    packed = {r.uid: r.p for r in df.select("uid", pack_recs("recs").alias("p")).collect()}
    assert packed == {1: "22:4.5|45:3.8", 2: "", 3: "7:1.0"}
    back = spark.createDataFrame([("22:4.5|45:3.8",), ("",), ("7:1.0",)], "t string").select(unpack_recs("t").alias("u")).collect()
    assert [[(x.rid, x.r) for x in r.u] for r in back] == [[(22, 4.5), (45, 3.8)], [], [(7, 1.0)]]


def test_cosine_zero_vector_is_nan_or_null(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0]), ([0.0, 0.0], [1.0, 1.0]), ([1.0, 0.0], [0.0, 1.0])], "a array<double>, b array<double>")
    got = [r[0] for r in df.select(cosine("a", "b")).collect()]
    assert got[0] == 1.0 and (got[1] is None or math.isnan(got[1])) and got[2] == 0.0


def test_sql_functions_registered(spark):
    register_sql_functions(spark)
    r = spark.sql("SELECT changeDate(1261000000) m, halfUp(2.675, 2) h, splitGe('Noir|Family') g").first()
    assert (r.m, r.h, r.g) == (200912, 2.68, ["Noir", "Family"])
    assert spark.createDataFrame([(1,)], "x int").select(F.expr("changeDate(1262304000)")).first()[0] == 201001


def test_pack_prints_doubles_like_spark_and_oracle_agrees(spark):
    import duckdb

    from cinerank.plans.oracle import java_double

    values = [2.328198, -0.000378, 1e-06, -3.78e-05, 0.0009, 0.001, 1.0, 0.0]
    df = spark.createDataFrame([(1, [(i, v) for i, v in enumerate(values)])], "uid int, recs array<struct<rid:int,r:double>>")
    packed = df.select(pack_recs("recs")).first()[0]
    rows = ",".join(f"({v}::DOUBLE, {i})" for i, v in enumerate(values))
    expect = duckdb.sql(f"SELECT string_agg(CAST(i AS VARCHAR) || ':' || {java_double('x')}, '|' ORDER BY i) FROM (VALUES {rows}) t(x, i)").fetchall()[0][0]
    assert packed == expect == "0:2.328198|1:-3.78E-4|2:1.0E-6|3:-3.78E-5|4:9.0E-4|5:0.001|6:1.0|7:0.0"
