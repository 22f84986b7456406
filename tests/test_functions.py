from pyspark.sql import functions as F
import pytest

from odflow.functions.scalar import (
    fixed_decimals, latin1_text, parse_bool, parse_date, parse_int_strict, round_half_even_int, safe_div, try_int,
)


def _one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


@pytest.mark.parametrize("text,expected", [
    ("12", 12), (" 12 ", 12), ("01001", 1001), ("12.7", 13), ("12.5", 13), ("1e3", 1000),
    ("NA", None), ("", None), ("x1", None), (None, None), ("-3", -3),
])
def test_try_int(spark, text, expected):
    assert _one(spark, try_int("v"), text) == expected


def test_parse_int_strict_raises(spark):
    with pytest.raises(Exception, match="cannot cast"):
        _one(spark, parse_int_strict("v", "code"), "abc")
    assert _one(spark, parse_int_strict("v", "code"), None) is None


@pytest.mark.parametrize("value,expected", [(12.5, 12), (13.5, 14), (12.4, 12), (-2.5, -2), (7.0, 7)])
def test_round_half_even(spark, value, expected):
    assert _one(spark, round_half_even_int("v"), value, "v double") == expected


def test_parse_date_both_forms(spark):
    import datetime as dt
    assert _one(spark, parse_date("v"), "2023-01-05") == dt.date(2023, 1, 5)
    assert _one(spark, parse_date("v"), "20230105") == dt.date(2023, 1, 5)
    assert _one(spark, parse_date("v"), "5/1/2023") is None
    with pytest.raises(Exception, match="DATE"):
        _one(spark, parse_date("v", strict=True), "junk")


@pytest.mark.parametrize("text,expected", [("true", True), ("T", True), ("yes", True), ("1", True),
                                           ("false", False), ("no", False), ("0", False), ("si", None)])
def test_parse_bool(spark, text, expected):
    assert _one(spark, parse_bool("v"), text) == expected


def test_latin1(spark):
    assert _one(spark, latin1_text(F.col("v")), "a→é") == "aé"
    assert _one(spark, latin1_text(F.col("v")), "L'Eliana \U0001F600") == "L'Eliana "


def test_fixed_decimals_and_safe_div(spark):
    assert _one(spark, fixed_decimals("v", 4), 1.23456, "v double") == "1.2346"
    row = spark.range(1).select(safe_div(F.lit(1.0), F.lit(0.0)).alias("a"), safe_div(F.lit(3.0), F.lit(2.0)).alias("b")).first()
    assert row["a"] is None and row["b"] == 1.5
