import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewell.functions import (
    TITLE_PATTERN, epoch_date, first_title, hash_bucket, parse_token, words,
)
from tidewell.streaming import count_words


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column).first()[0]


@pytest.mark.parametrize("text, title", [
    ("abc", ""), ("Rothes, the Countess. of (Lucy)", "Countess"), ("", ""), ("a.b.", "a"),
    ("é1 éab. x", "ab"), ("x1. y2 zz.", "zz"), ("no dot Mr then Mrs. Smith.", "Mrs"),
])
def test_first_title(spark, text, title):
    assert one(spark, first_title(F.col("v")), text) == title


def test_first_title_is_what_the_pattern_finds(spark):
    @settings(max_examples=30, deadline=None)
    @given(st.lists(st.text("abZ.é 1", max_size=12), min_size=20, max_size=20))
    def check(texts):
        df = spark.createDataFrame([(t,) for t in texts], "v string")
        found = [r[0] for r in df.select(first_title(F.col("v"))).collect()]
        matches = [re.search(TITLE_PATTERN, t) for t in texts]
        assert found == [m.group(1) if m else "" for m in matches]

    check()


def test_first_title_takes_linear_time(spark):
    text = "a" * 3_000_000
    assert one(spark, first_title(F.col("v")), text) == ""


@pytest.mark.parametrize("text, expected", [
    ("  a b ", ["", "a", "b", ""]), ("", [""]), ("a\t\n b", ["a", "b"]), (None, None),
])
def test_words(spark, text, expected):
    assert one(spark, words(F.col("v")), text) == expected


def test_null_text_has_no_words(spark):
    df = spark.createDataFrame([(None,), ("x x",)], "body string")
    assert rows(count_words(df, "body")) == [("x", 2)]


def test_binary_text_is_decoded(spark):
    df = spark.createDataFrame([(b"x y",)], "body binary")
    assert rows(count_words(df, "body")) == [("x", 1), ("y", 1)]


@pytest.mark.parametrize("seconds", [0, 1469501107, 1469577599, 1469577600, -1, 4102444800])
def test_epoch_date_is_what_the_formatter_gives(spark, seconds):
    fast = one(spark, epoch_date(F.col("v")), seconds, "bigint")
    assert fast == one(spark, F.from_unixtime("v", "yyyy-MM-dd"), seconds, "bigint")


def test_epoch_date(spark):
    assert one(spark, epoch_date(F.col("v")), 1469501107, "bigint") == "2016-07-26"
    assert one(spark, epoch_date(F.col("v"), "yyyy/MM"), 1469501107, "bigint") == "2016/07"


@pytest.mark.parametrize("token, tag, value", [
    ("--", "int", -1), ("-5", "int", -1), ("7", "int", 7), ("7.5", "int", None),
    ("", "int", None), ("x", "int", None), (" 8 ", "int", 8),
    ("2.5", "double", 2.5), ("-1e3", "double", -1000.0), ("x", "double", None),
    ("1.5f", "double", None), ("1d", "double", None), ("inf", "double", float("inf")),
    ("x-1", "string", "x-1"), (None, "int", None), (None, "double", None),
])
def test_parse_token(spark, token, tag, value):
    assert one(spark, parse_token(F.col("v"), tag), token) == value


def test_parse_token_keeps_negatives_on_request(spark):
    assert one(spark, parse_token(F.col("v"), "int", dash_as=None), "-5") == -5


def test_hash_bucket_does_not_depend_on_the_layout(spark):
    df = spark.range(1000)
    bucket = hash_bucket(F.col("id")).alias("b")
    assert rows(df.select("id", bucket)) == rows(df.repartition(7).select("id", bucket))
    spread = df.select((bucket < 80).cast("int").alias("t")).agg(F.avg("t")).first()[0]
    assert 0.7 < spread < 0.9
