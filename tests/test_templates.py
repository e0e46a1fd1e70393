"""Analyst SQL templates (Q1-Q8) over the published views of a small run."""

import os
import tempfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from catloss.functions.exprs import clip_keep_null, ieee_div
from catloss.plans import registry
from catloss.sql import templates as TPL
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def views(spark):
    fr = registry.frames(spark, SF_SMALL)
    registry.register_output_views(fr)
    root = tempfile.mkdtemp(prefix="catloss-views-")  # published once, as a run does, not recomputed by every template
    for t in TPL.CORE_TABLES:
        spark.table(t).write.parquet(f"{root}/{t}")
        spark.read.parquet(f"{root}/{t}").createOrReplaceTempView(t)
    return fr


def test_inventory_and_dictionary(spark, views):
    counts = {r.table_name: r.rows for r in TPL.inventory_row_counts(spark).collect()}
    assert set(counts) == set(TPL.CORE_TABLES) and all(v > 0 for v in counts.values())
    cols = TPL.inventory_columns(spark)
    wide = [r for r in cols.collect() if r.table_name == TPL.WIDE_TABLE]
    assert [r.column_name for r in wide] == spark.table(TPL.WIDE_TABLE).columns
    assert {r.rows for r in wide} == {spark.table(TPL.WIDE_TABLE).count()}
    assert TPL.wide_loss_columns(spark)[0].startswith("euws_override_")


def test_portfolio_filter_and_seed_checks(spark, views):
    everything = TPL.stage_counts(spark).count()
    one = TPL.stage_counts(spark, rollup_lob="RL0", rollup_peril="Europe_WS")
    assert 0 < one.count() < everything
    assert {r.rollup_lob for r in one.collect()} == {"RL0"}
    checks = TPL.seed_checks(spark)
    assert checks["lob_mappings"].count() == 5 and checks["forecast_factors"].count() == 2
    assert TPL.report_losses_by_portfolio(spark).count() == spark.table(TPL.REPORT_TABLE).count()


def test_export_example_writes_csv(spark, views):
    path = os.path.join(tempfile.mkdtemp(prefix="catloss-export-"), "extract.csv")
    TPL.export_example(spark, path, n=10)
    df = spark.read.option("header", True).csv(path)
    assert df.count() == 10 and set(r.metric for r in df.collect()) == {"euws_override"}


def test_column_statistics(spark):
    """Least and greatest values by type; null-only and empty columns have none."""
    df = spark.createDataFrame([(1, "b", None, 2.5), (3, "a", None, None)], "id int, name string, nothing date, `odd name` double")
    df.createOrReplaceTempView("inv_some")
    df.where("id > 9").createOrReplaceTempView("inv_none")
    got = [tuple(r) for r in TPL.inventory_columns(spark, ["inv_some", "inv_none"]).collect()]
    assert got[:4] == [
        ("inv_none", 1, "id", "INTEGER", 0, 0, None, None, None, None),
        ("inv_none", 2, "name", "VARCHAR", 0, 0, None, None, None, None),
        ("inv_none", 3, "nothing", "DATE", 0, 0, None, None, None, None),
        ("inv_none", 4, "odd name", "DOUBLE", 0, 0, None, None, None, None),
    ]
    assert got[4:] == [
        ("inv_some", 1, "id", "INTEGER", 2, 0, 1.0, 3.0, None, None),
        ("inv_some", 2, "name", "VARCHAR", 2, 0, None, None, "a", "b"),
        ("inv_some", 3, "nothing", "DATE", 2, 2, None, None, None, None),
        ("inv_some", 4, "odd name", "DOUBLE", 2, 1, 2.5, 2.5, None, None),
    ]


def test_monthly_check_agrees_with_each_month(spark, views):
    months = TPL.wide_months(spark)
    assert len(months) > 1
    every = TPL.wide_portfolio_months(spark).collect()
    for m in months:
        one = {(r.base_model, r.rollup_lob, r.rollup_peril): (r.rows, r.final_main_loss) for r in TPL.wide_portfolio_check(spark, m).collect()}
        got = {(r.base_model, r.rollup_lob, r.rollup_peril): (r.rows, r.final_main_loss) for r in every if r.forecast_month == m}
        assert got.keys() == one.keys()
        assert all(got[k][0] == one[k][0] and got[k][1] == pytest.approx(one[k][1]) for k in one)


finite = st.floats(allow_nan=False, allow_infinity=False, width=64, min_value=-1e12, max_value=1e12)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), finite), st.one_of(st.none(), finite)), min_size=1, max_size=30))
def test_ieee_div_and_clip_match_python(spark, pairs):
    df = spark.createDataFrame(pairs, "a double, b double")
    got = df.select(ieee_div("a", "b").alias("q"), clip_keep_null(ieee_div("a", "b"), 0.1, 10.0).alias("c")).collect()
    for (a, b), row in zip(pairs, got):
        if a is None or b is None:
            assert row.q is None and row.c is None
            continue
        if b != 0:
            expected = a / b
        elif a == 0:
            expected = float("nan")
        else:
            expected = float("inf") if a > 0 else float("-inf")
        if expected != expected:
            assert row.q != row.q and row.c != row.c
        else:
            assert row.q == expected
            assert row.c == min(max(expected, 0.1), 10.0)
