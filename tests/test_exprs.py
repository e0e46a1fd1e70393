"""Spark-vs-reference numeric and string semantics (ANSI mode on)."""

import math

import pytest
from pyspark.sql import functions as F

from catloss.functions.exprs import (
    clip_keep_null, ieee_div, parse_loss, rp_bucket, strip_ws, sum0, vendor_years,
)


def _one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr.alias("x")).collect()]


def test_ieee_div_follows_ieee(spark):
    out = _one(spark, ieee_div("a", "b"), [(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (None, 1.0), (6.0, 3.0)],
               "a double, b double")
    assert out[0] == math.inf and out[1] == -math.inf and math.isnan(out[2])
    assert out[3] is None and out[4] == 2.0


def test_clip_keeps_null_and_nan(spark):
    out = _one(spark, clip_keep_null("x", 0.1, 10.0), [(None,), (float("nan"),), (0.01,), (50.0,), (2.0,)],
               "x double")
    assert out[0] is None and math.isnan(out[1]) and out[2:] == [0.1, 10.0, 2.0]


def test_sum0_of_all_null_group_is_zero(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 2.0)], "k string, v double")
    got = {r.k: r.s for r in df.groupBy("k").agg(sum0("v").alias("s")).collect()}
    assert got == {"a": 0.0, "b": 2.0}


def test_strip_ws_removes_tabs_and_spaces(spark):
    assert _one(spark, strip_ws("s"), [(" \tSTC  \n",), (None,)], "s string") == ["STC", None]


def test_strip_ws_equals_the_trim_of_all_white_space(spark):
    from catloss.functions.exprs import WHITE_SPACE
    ends = ["", " ", "\t", " \x0b ", "\u3000", "\x85", "\x1f", "\x7f", "\u00e9", "~", "!"]
    texts = [a + m + b for a in ends for m in ("", "x", "x \t y", "\u2003") for b in ends]
    frame = spark.createDataFrame([(t,) for t in texts], "s string")
    assert [r[0] for r in frame.select(strip_ws("s")).collect()] == [t.strip(WHITE_SPACE) for t in texts]
    plan = frame.select(strip_ws("s").alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in plan  # the trim of many characters is for odd ends only


def test_parse_loss_guards_java_suffixes(spark):
    out = _one(spark, parse_loss("s"), [(" 1,750,472 ",), ("10d",), ("",), ("2.5e3",), ("-,123",)], "s string")
    assert out == [1750472.0, None, None, 2500.0, -123.0]


def test_rp_bucket_and_vendor_years(spark):
    df = spark.createDataFrame([("verisk", 1), ("verisk", 20), ("risklink", 400), ("other", 1)], "v string, r long")
    got = df.select(
        (vendor_years("v", {"verisk": 10000, "risklink": 100000}) / F.col("r")).alias("rp")
    ).select("rp", rp_bucket("rp", [200, 1000]).alias("b")).collect()
    assert [(r.rp, r.b) for r in got] == [(10000.0, 1000), (500.0, 200), (250.0, 200), (None, 0)]


@pytest.mark.parametrize("values, total", [([4e-7, 4e-7], 8e-7), ([1.0e13, 2.0e13], 3.0e13), ([None, None], 0.0), ([1.0, math.inf], math.inf)])
def test_sum0_keeps_small_and_large_values(spark, values, total):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert df.agg(sum0("x")).first()[0] == total
