import datetime as dt

from pyspark.sql import functions as F

from marginalia import functions as M


def one(spark, expr, schema="x string", data=(("a",),)):
    return spark.createDataFrame(list(data), schema).select(expr.alias("r")).collect()


def test_safe_div_zero_and_null(spark):
    rows = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0)], "a double, b double") \
        .select(M.safe_div("a", "b").alias("r")).collect()
    assert [r.r for r in rows] == [None, None, 1.5]


def test_month_diff_counts_boundaries(spark):
    r = spark.createDataFrame([(dt.date(2024, 3, 1), dt.date(2024, 1, 31))], "a date, b date") \
        .select(M.month_diff("a", "b").alias("r")).first().r
    assert r == 2


def test_weeks(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 7),), (dt.date(2024, 1, 8),)], "d date")  # Sun, Mon
    rows = df.select(M.monday_week("d").alias("m"), M.sunday_week("d").alias("s")).collect()
    assert rows[0].m == dt.date(2024, 1, 1) and rows[0].s == dt.date(2024, 1, 7)
    assert rows[1].m == dt.date(2024, 1, 8) and rows[1].s == dt.date(2024, 1, 7)


def test_round_to_long_half_away(spark):
    rows = spark.createDataFrame([(2.5,), (3.5,), (-2.5,)], "x double").select(M.round_to_long("x").alias("r")).collect()
    assert [r.r for r in rows] == [3, 4, -3]


def test_tolerant_numbers(spark):
    df = spark.createDataFrame([("1000",), ("3.0",), ("not_a_number",), (None,), ("12.34",)], "x string")
    rows = df.select(M.try_long("x").alias("i"), M.try_double("x").alias("f")).collect()
    assert [r.i for r in rows] == [1000, 3, None, None, 12]
    assert [r.f for r in rows] == [1000.0, 3.0, None, None, 12.34]


def test_utm_param(spark):
    urls = [("/p?utm_source=fb+ads%21&utm_medium=cpc",), ("/p?utm_source=&x=1",), ("/p?utm_source=a%2",),
            ("/p",), (None,)]
    rows = spark.createDataFrame(urls, "u string").select(M.utm_param("u", "source").alias("s")).collect()
    assert [r.s for r in rows] == ["fb ads!", None, "a%2", None, None]


def test_gid_and_domain(spark):
    df = spark.createDataFrame([("gid://shopify/Order/123", "sc-domain:example.com"),
                                ("gid://shopify/Order/x", "https://www.shop.com/")], "g string, p string")
    rows = df.select(M.gid_to_long("g").alias("g"), M.domain_label("p").alias("d")).collect()
    assert rows[0].g == 123 and rows[0].d == "example.com"
    assert rows[1].g is None and rows[1].d == "www.shop.com"


def test_regex_group_or_null(spark):
    df = spark.createDataFrame([("Transaction ID: 7XA1",), ("no id",)], "m string")
    rows = df.select(M.regex_group_or_null(F.col("m"), r"Transaction ID:\s*([A-Z0-9]+)").alias("r")).collect()
    assert [r.r for r in rows] == ["7XA1", None]
