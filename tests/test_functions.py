"""Null rules for the scalar expressions."""

from pyspark.sql import functions as F

from finpanel import functions as fx


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_safe_div_zero_and_null(spark):
    out = one(spark, fx.safe_div("a", "b"), [(1.0, 0.0), (None, 2.0), (4.0, 2.0), (1.0, None)], "a double, b double")
    assert out == [None, None, 2.0, None]


def test_clip_keeps_null(spark):
    out = one(spark, fx.clip("a", -5, 5), [(None,), (7.0,), (-9.0,), (1.0,)], "a double")
    assert out == [None, 5.0, -5.0, 1.0]


def test_coerce_numeric(spark):
    out = one(spark, fx.coerce_numeric("s"), [("abc",), ("1.5",), (None,)], "s string")
    assert out == [None, 1.5, None]
    out = one(spark, fx.coerce_numeric("s", "int"), [("20250228.0",), ("x",)], "s string")
    assert out == [20250228, None]


def test_qtrs_default(spark):
    assert one(spark, fx.qtrs_default("s"), [(None,), ("4",), ("bad",)], "s string") == [-1, 4, -1]


def test_code_prefix_leading_zero(spark):
    assert one(spark, fx.code_prefix("s"), [("0100",), ("5171",), (None,)], "s string") == [10, 51, None]


def test_day_lag_invalid_date(spark):
    out = one(spark, fx.day_lag("a", "b"), [(20250101, 20250131), (20250101, 20251340)], "a int, b int")
    assert out == [30, None]


def test_flags(spark):
    d = [(None,), (-1.0,), (2.0,)]
    assert one(spark, fx.bool_flag_null(F.col("x") < 0, "x"), d, "x double") == [None, 1, 0]
    assert one(spark, fx.bool_flag_zero(F.col("x") < 0), d, "x double") == [0, 1, 0]


def test_bins_and_codes(spark):
    edges, labels = [0, .2, .45, .65, .85, 1.01], ["a", "b", "c", "d", "e"]
    out = one(spark, fx.bin_right_open("x", edges, labels), [(0.2,), (0.85,), (1.0,), (None,), (-1.0,)], "x double")
    assert out == ["b", "e", "e", None, None]
    assert one(spark, fx.map_codes("s", {"Q1": 1, "FY": 4}, 99), [("Q1",), ("Q4",)], "s string") == [1, 99]
    assert one(spark, fx.period_label("fy", "fp"), [(2021, "Q1"), (2021, None)], "fy int, fp string") == ["2021-Q1", None]


def test_row_counts(spark):
    d = [(1.0, None, 2.0)]
    assert one(spark, fx.row_count_present(["a", "b", "c"]), d, "a double, b double, c double") == [2]
    assert one(spark, fx.row_sum(["a", "b", "c"]), d, "a double, b double, c double") == [3.0]
    assert one(spark, fx.row_all_present(["a", "b"]), d, "a double, b double, c double") == [False]
