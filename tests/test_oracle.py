"""Registered queries against their independent DuckDB SQL on the smallest test tables."""

import pytest

import __spark_entry__ as E
from catloss.check import compare, duck
from catloss.plans import registry
from tests.conftest import SF_SMALL

SAMPLE = [
    "stage_risklink_events", "ylt_ranked_range", "main_metric_stream", "dialsup_metrics", "main_fanout",
    "wide_output", "ep_report", "ep_wide_to_long", "dimension_coverage", "input_aal_summary", "quality_rules",
    "q_event_waterfall",
]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.oracle_sql())


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    res = compare(E.queries()[name](spark, SF_SMALL), con, E.oracle_sql()[name], name)
    assert res["match"], res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[-1] == "output_use"
    assert df.limit(5).count() >= 0
