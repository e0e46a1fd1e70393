from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from catloss import schemas as SC  # noqa: E402
from catloss.session import ensure_checkpoint_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    s = (
        SparkSession.builder.master("local[*]")
        .appName("catloss-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


def rows(spark, schema, records: list[dict]):
    """Frame with ``schema``; fields missing from a record are null."""
    names = [f.name for f in schema.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], schema)


def ranked_row(**kw) -> dict:
    base = dict(
        vendor="verisk", analysis_id="A1", modelled_lob="LOB1", modelled_peril="P1", rollup_lob="RL0",
        rollup_peril="Europe_WS", region_peril_id=206, blend_subregion_peril_id="206a", base_model="verisk",
        selection_priority=1, is_dialsup=1, is_euws=1, cds_cat_class_name="Class A", **{"class": "HH"},
        office="DE", currency="EUR", model_code=41, year_id=1, event_id=1, loss=100.0, metric="original",
        rnk=1, rp=10000.0, rp_bucket=1000,
    )
    base.update(kw)
    return base


@pytest.fixture()
def schemas():
    return SC
