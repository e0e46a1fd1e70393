"""YLT branch and main/dialsup stages (worked examples U5-U9) and rank properties."""

import random

import pytest
from pyspark.sql import functions as F

from catloss import schemas as SC
from catloss.operators import main_stream as MS
from catloss.operators import staging as ST
from catloss.operators import ylt as YL
from catloss.params import RunParams
from tests.conftest import ranked_row, rows

U5_ROWS = [(200.0, 2026, 9, "A", 1), (100.0, 2026, 2, "A", 1), (100.0, 2025, 3, "A", 1), (100.0, 2025, 1, "A", 1)]
U5_EXPECTED = {(200.0, 2026, 9): 1, (100.0, 2025, 1): 2, (100.0, 2025, 3): 3, (100.0, 2026, 2): 4}


def _base(spark, data, cell_lob="LOB1"):
    recs = [dict(ranked_row(loss=l, year_id=y, event_id=e, analysis_id=a, model_code=m, modelled_lob=cell_lob))
            for l, y, e, a, m in data]
    return rows(spark, SC.YLT_BASE, recs)


@pytest.mark.parametrize("strategy", ["window", "range"])
def test_u5_tie_break_order(spark, strategy):
    for data in (U5_ROWS, list(reversed(U5_ROWS))):
        got = {(r.loss, r.year_id, r.event_id): r.rnk
               for r in YL.rank_events(_base(spark, data), RunParams(), strategy=strategy, partitions=3).collect()}
        assert got == U5_EXPECTED


def test_range_rank_equals_window_rank_on_a_hot_cell(spark):
    rnd = random.Random(7)
    data = [(float(rnd.choice([100, 200, 300, 400])), rnd.randint(1, 30), rnd.randint(1, 50), rnd.choice("AB"),
             rnd.choice([41, 42])) for _ in range(3000)]
    # one cell holds almost everything; a second small cell checks offsets per cell
    df = _base(spark, data).unionByName(_base(spark, data[:100], cell_lob="LOB2"))
    cols = ["modelled_lob", "loss", "year_id", "event_id", "analysis_id", "model_code", "rnk", "rp", "rp_bucket"]
    w = YL.rank_events(df, RunParams(), strategy="window").select(*cols)
    r = YL.rank_events(df, RunParams(), strategy="range", partitions=11).select(*cols)
    assert w.exceptAll(r).count() == 0 and r.exceptAll(w).count() == 0
    ranks = sorted(x.rnk for x in r.where(F.col("modelled_lob") == "LOB1").collect())
    assert ranks == list(range(1, 3001))


def test_u8_padded_stc_rows_and_keys_are_stripped(spark):
    raw = spark.createDataFrame(
        [("VP1  ", " LOB1 ", "STC     ", 1, 41, 1, 10.0), ("VP1  ", " LOB1 ", "HIST    ", 2, 41, 1, 10.0)],
        SC.RAW_VERISK_YLT,
    )
    got = ST.stage_verisk_ylt(raw).collect()
    assert len(got) == 1
    assert (got[0].analysis_id, got[0].modelled_peril, got[0].modelled_lob) == ("VP1", "VP1", "LOB1")


def test_u9_malformed_forecast_date_fails(spark):
    bad = spark.createDataFrame([("HH", "Germany", "DE", "31/12/2026", 1.1)], SC.SEED_SCHEMAS["forecast_factors"])
    with pytest.raises(Exception):
        ST.stage_forecast_factors(bad).collect()


def test_risklink_events_keep_earliest_date(spark):
    import datetime as dt
    raw = spark.createDataFrame(
        [(7, 2025, 216, dt.datetime(2025, 2, 21)), (7, 2025, 216, dt.datetime(2025, 2, 11))],
        SC.SEED_SCHEMAS["risklink_flood22_model_events"],
    )
    got = ST.stage_risklink_events(raw).first()
    assert got.risklink_event_day == 42


def test_u7_blend_keeps_diagnostics(spark):
    ranked = rows(spark, SC.YLT_RANKED, [ranked_row(loss=10.0, rp_bucket=200)])
    targets = rows(spark, SC.EP_TARGETS, [dict(
        rollup_lob="RL0", rollup_peril="Europe_WS", region_peril_id=206, blend_subregion_peril_id="206a",
        base_model="verisk", ep_type="OEP", return_period=200, risklink_blended_contribution=150.0,
        verisk_blended_contribution=25.0, uplift_factor_on_base_model=0.875)])
    b = MS.blend(ranked, targets).first()
    assert (b.loss, b.metric) == (8.75, "blended")
    assert (b.risklink_blended_contribution, b.verisk_blended_contribution) == (150.0, 25.0)


def _chain_inputs(spark):
    ranked = rows(spark, SC.YLT_RANKED, [ranked_row(loss=88.0, currency="EUR", rnk=50, rp_bucket=0,
                                                     event_id=5, year_id=3, model_code=41)])
    targets = rows(spark, SC.EP_TARGETS, [dict(
        rollup_lob="RL0", rollup_peril="Europe_WS", region_peril_id=206, blend_subregion_peril_id="206a",
        base_model="verisk", ep_type="AAL", return_period=0, risklink_blended_contribution=0.0,
        verisk_blended_contribution=88.0, uplift_factor_on_base_model=1.0)])
    fx = rows(spark, SC.FX, [dict(currency="EUR", target_currency="GBP", fx_rate_date="2026-01-01", fx_rate=0.88)])
    import datetime as dt
    dates = spark.createDataFrame([(dt.date(2026, 1, 1),)], SC.FORECAST_DATES)
    factors = rows(spark, SC.FORECAST_FACTORS, [{"class": "HH", "office": "DE", "forecast_date": dt.date(2026, 1, 1),
                                                 "_forecast_factor_raw": 2.5}])
    events = rows(spark, SC.VERISK_EVENTS, [dict(model_event_id=900, model_code=41, event_id=5, year_id=3,
                                                 event_day=12)])
    euws = spark.createDataFrame([(900, 3, 0.0)], SC.SEED_SCHEMAS["euws_rate_factors"])
    overrides = spark.createDataFrame([("RL0", 100, 1.0)], SC.SEED_SCHEMAS["euws_rank_overrides"])
    return ranked, targets, fx, dates, factors, events, euws, overrides


def test_u6_chain_and_fused_stream(spark):
    ranked, targets, fx, dates, factors, events, euws, overrides = _chain_inputs(spark)
    blended = MS.blend(ranked, targets)
    local = MS.to_local_currency(blended, fx)
    fc = MS.forecast(local, dates, factors)
    eu = MS.event_factor(fc, events, euws)
    ov = MS.rank_override(eu, overrides)
    assert local.first().loss == pytest.approx(100.0)
    assert fc.first().loss == pytest.approx(250.0)
    assert eu.first().loss == 0.0 and eu.first().model_event_id == 900
    assert ov.first().loss == pytest.approx(250.0)
    union = MS.union_stages(ranked, blended, local, fc, eu, ov)
    from catloss.operators.lookups import attach_catalogue
    fused = MS.main_metric_stream(attach_catalogue(ranked, events, euws), targets, fx, dates, factors, overrides)
    assert fused.exceptAll(union).count() == 0 and union.exceptAll(fused).count() == 0
    assert sorted(r.metric for r in fused.collect()) == sorted(MS.MAIN_STAGES)
