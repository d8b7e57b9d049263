import math

from tests.conftest import SF_DIR, rows
from tidewell.operators import (
    column_summary, exact_summary, global_mean, group_count, group_mean, mean_between, non_null_count,
    null_profile, row_count, text_summary, top_rows,
)
from tidewell.plans.registry import table


def test_null_group_is_its_own(spark):
    df = spark.createDataFrame([("a",), (None,), (None,)], "k string")
    assert rows(group_count(df, ["k"])) == [(None, 2), ("a", 1)]
    assert rows(non_null_count(df, ["k"], "k", "n")) == [(None, 0), ("a", 1)]
    assert rows(row_count(df)) == [(3,)]


def test_means(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", None)], "k string, v double")
    assert global_mean(df, "v") == 1.5
    assert rows(group_mean(df, ["k"], "v", "m")) == [("a", 1.5), ("b", None)]
    assert global_mean(df.where("k = 'b'"), "v") is None


def test_mean_between_filters_before_the_shuffle(spark, plan_of):
    df = spark.createDataFrame([(0, 1.0), (5, 2.0), (5, 4.0), (10, 9.0)], "y int, v double")
    means = mean_between(df, "y", "v", 0, 10, "m")
    assert rows(means) == [(3.0, 5)]
    orders = table(spark, SF_DIR, "orders")
    plan = plan_of(mean_between(orders, "o_custkey", "o_totalprice", 10, 20, "m"))
    assert "GreaterThan(o_custkey,10)" in plan and "LessThan(o_custkey,20)" in plan


def test_null_profile(spark, plan_of):
    df = spark.createDataFrame([(1, None, float("nan")), (None, None, 1.0)],
                               "a int, `b.c` string, d double")
    profile = null_profile(df)
    assert plan_of(profile).count("Scan ExistingRDD") == 1
    assert rows(profile) == [("a", 1), ("b.c", 2)]


def test_null_profile_of_a_full_table_is_empty(spark):
    profile = null_profile(spark.createDataFrame([(1, "x")], "a int, b string"))
    assert profile.columns == ["column_name", "null_count"] and profile.count() == 0


def test_column_summary(spark):
    df = spark.createDataFrame([(1, 2.0, "x"), (3, None, "y")], "a int, b double, s string")
    result = {r["column_name"]: r for r in column_summary(df).collect()}
    assert set(result) == {"a", "b"}
    a, b = result["a"], result["b"]
    assert (a["count"], a["mean"], a["min"], a["max"]) == (2, 2.0, 1.0, 3.0)
    assert math.isclose(a["stddev"], math.sqrt(2))
    assert (b["count"], b["mean"], b["stddev"]) == (1, 2.0, None)


def test_text_summary(spark):
    df = spark.createDataFrame([("b", 1), (None, 2), ("a", 3)], "s string, n int")
    assert rows(text_summary(df)) == [("s", 2, "a", "b")]


def test_top_rows_does_not_sort_everything(spark, plan_of):
    top = top_rows(table(spark, SF_DIR, "orders"), 3, ["o_orderkey"])
    assert "TakeOrderedAndProject" in plan_of(top)
    assert top.count() == 3


def test_exact_summary_keeps_every_digit(spark):
    df = spark.sql("""
        SELECT 9007199254740993 AS k, CAST('12345678901234567890.0123456789' AS DECIMAL(38, 10)) AS `a.d`,
               DATE'2024-02-29' AS day, 'é' AS s, CAST(null AS double) AS x, true AS b
        UNION ALL SELECT -1, null, DATE'1999-12-31', 'Z', null, false""")
    assert rows(exact_summary(df)) == [
        ("a.d", "decimal(38,10)", 1, *["12345678901234567890.0123456789"] * 2),
        ("b", "boolean", 2, "false", "true"), ("day", "date", 2, "1999-12-31", "2024-02-29"),
        ("k", "bigint", 2, "-1", "9007199254740993"), ("s", "string", 2, "Z", "é"), ("x", "double", 0, None, None)]
