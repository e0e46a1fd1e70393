"""Marts, fanout, wide output (worked examples U10, U11, U13, U14)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from catloss import schemas as SC
from catloss.operators import marts as MT
from catloss.operators import wide as WD
from catloss.params import RunParams
from tests.conftest import ranked_row, rows

D1, D2, D3 = dt.date(2026, 1, 1), dt.date(2026, 7, 1), dt.date(2026, 12, 31)


def _stream(spark, records):
    return rows(spark, SC.MAIN_STREAM, [dict(ranked_row(), **r) for r in records])


@pytest.mark.parametrize("threshold,expected", [(1000.0, [None, 1000.0]), (0.0, [None, 999.0, 1000.0])])
def test_u10_threshold_only_on_final_rows(spark, threshold, expected):
    s = _stream(spark, [dict(metric="original", loss=None)] + [
        dict(metric="euws_override", loss=v, forecast_date=D1) for v in (None, 999.0, 1000.0)])
    got = sorted((r.loss for r in MT.main_long(s, threshold).collect()), key=lambda v: (v is not None, v))
    assert got == expected


def test_u11_risklink_rows_need_their_occurrence(spark):
    s = _stream(spark, [
        dict(metric="euws_override", base_model="risklink", vendor="risklink", event_id=7, year_id=2025,
             region_peril_id=216, forecast_date=D1, loss=5000.0, target_currency="EUR"),
        dict(metric="euws_override", base_model="risklink", vendor="risklink", event_id=7, year_id=2026,
             region_peril_id=216, forecast_date=D1, loss=5000.0, target_currency="EUR"),
        dict(metric="euws_override", base_model="verisk", event_id=8, year_id=2026, model_event_id=99,
             event_day=3, forecast_date=D1, loss=5000.0, target_currency="EUR"),
    ])
    events = rows(spark, SC.RISKLINK_EVENTS, [dict(event_id=7, model_occurrence_year=2025, region_peril_id=216,
                                                   risklink_event_day=42)])
    fan = MT.main_fanout(MT.main_long(s, 1000.0), events)
    assert fan.columns == SC.names(SC.FANOUT)
    got = sorted((r.base_model, r.ModelEventID, r.ModelYear, r.ModelEventDay) for r in fan.collect())
    assert got == [("risklink", 7, 2025, 42), ("verisk", 99, 2026, 3)]


def _long_frames(spark, dates):
    main = rows(spark, SC.MAIN_LONG, [dict(ranked_row(), metric="euws_override", forecast_date=d, loss=100.0,
                                           target_currency="EUR", risklink_blended_contribution=1.0,
                                           verisk_blended_contribution=2.0, uplift_factor_on_base_model=0.5,
                                           output_use="cds_main") for d in dates])
    dial = rows(spark, SC.DIALSUP_LONG, [dict(ranked_row(), metric="dialsup_localccy_forecast", forecast_date=d,
                                              loss=50.0, target_currency="EUR", output_use="cds_dialsup")
                                         for d in dates])
    return main, dial


def test_u13_wide_has_contract_columns(spark):
    main, dial = _long_frames(spark, [D1, D2, D3])
    wide = WD.wide_output(main, dial)
    assert len(wide.columns) == 35
    assert wide.columns[:5] == ["vendor", "analysis_id", "base_model", "output_use", "model_code"]
    assert wide.columns[-6:] == [
        "euws_override_202601_loss", "euws_override_202607_loss", "euws_override_202612_loss",
        "dialsup_localccy_forecast_202601_loss", "dialsup_localccy_forecast_202607_loss",
        "dialsup_localccy_forecast_202612_loss",
    ]
    row = wide.first()
    assert row.euws_override_202607_loss == 100.0 and row.dialsup_localccy_forecast_202612_loss == 50.0
    assert row.uplift_factor_on_base_model == 0.5 and row.output_use == "cds_wide_analysis"


def test_u14_duplicate_grain_is_rejected(spark):
    main, dial = _long_frames(spark, [D1, D1])
    with pytest.raises(Exception, match="duplicate grain rows"):
        WD.wide_output(main, dial).collect()


def test_two_dates_in_one_month_are_rejected(spark):
    main, dial = _long_frames(spark, [D1, dt.date(2026, 1, 15)])
    with pytest.raises(ValueError, match="share a month"):
        WD.wide_output(main, dial)


def test_wide_total_equals_long_total(spark):
    from tests.test_streams import bridge_frames
    fr = bridge_frames(spark)
    wide = fr.wide_output()
    loss_cols = [c for c in wide.columns if c.endswith("_loss")]
    wide_total = wide.select(sum(F.coalesce(F.col(c), F.lit(0.0)) for c in loss_cols).alias("t")).agg(
        F.sum("t")).first()[0]
    long_total = fr.wide_source.agg(F.sum("loss")).first()[0]
    assert wide_total == pytest.approx(long_total, rel=1e-12)


def test_ep_report_missing_and_zero_ranks(spark):
    import math
    from catloss.operators import report as RP
    from catloss.params import RunParams
    params = RunParams(simulation_counts={"verisk": 100}, return_periods=(50, 10, 1000))
    main = rows(spark, SC.MAIN_LONG, [dict(ranked_row(), metric="euws_override", forecast_date=D1, year_id=y,
                                           loss=l, output_use="cds_main")
                                      for y, l in [(1, 10.0), (1, 5.0), (2, 30.0), (3, 20.0)]])
    dial = rows(spark, SC.DIALSUP_LONG, [])
    got = {(r.ep_type, r.return_period): (r.rank, r.rp, r.loss) for r in RP.ep_report(main, dial, params).collect()}
    assert got[("AAL", 0)] == (0, 0.0, 0.65)
    assert got[("AEP", 50)] == (2, 50.0, 20.0) and got[("OEP", 50)] == (2, 50.0, 20.0)
    assert got[("AEP", 10)] == (10, 10.0, 0.0)            # only three simulated years carry losses
    rank0 = got[("OEP", 1000)]
    assert rank0[0] == 0 and math.isinf(rank0[1]) and rank0[2] == 0.0


@pytest.mark.parametrize("small", [True, False])
def test_fanout_join_paths_agree(spark, small):
    s = _stream(spark, [
        dict(metric="euws_override", base_model="risklink", vendor="risklink", event_id=7, year_id=y,
             region_peril_id=216, forecast_date=D1, loss=5000.0, target_currency="EUR") for y in (2025, 2026)
    ] + [dict(metric="euws_override", base_model=None, event_id=9, year_id=2025, forecast_date=D1, loss=5000.0),
         dict(metric="euws_override", base_model="verisk", event_id=8, year_id=2026, model_event_id=99,
              event_day=3, forecast_date=D1, loss=5000.0, target_currency="EUR")])
    events = rows(spark, SC.RISKLINK_EVENTS, [dict(event_id=7, model_occurrence_year=2025, region_peril_id=216,
                                                   risklink_event_day=42)])
    fan = MT.main_fanout(MT.main_long(s, 1000.0), events, catalogue_small=small)
    got = sorted((r.base_model, r.ModelEventID, r.ModelYear, r.ModelEventDay) for r in fan.collect())
    assert got == [("risklink", 7, 2025, 42), ("verisk", 99, 2026, 3)]


def test_ranks_are_selected_as_by_sorting(spark):
    """Ties, negative, zero, infinite, NaN and null losses; keys with nulls; ranks beyond a key's values."""
    import random

    from catloss.operators import report as RP
    rng = random.Random(1)
    odd = [0.0, -0.0, float("inf"), float("-inf"), float("nan"), None, 1e-300, -1e300, 5.0]
    data = [("a" if i % 3 else None, rng.choice([*odd, rng.lognormvariate(3, 4), round(rng.uniform(-50, 50), 1)])) for i in range(900)] + [("tied", 7.5)] * 500
    df = spark.createDataFrame(data, "k string, loss double").repartition(7)
    ranks = [1, 2, 3, 50, 299, 300, 301, 499, 500, 501, 600, 9999]
    targets = F.array(*[F.struct(F.lit(r).cast("long").alias("return_period"), F.lit(r).cast("long").alias("rank")) for r in ranks])
    got = sorted((str(r.k), r["rank"], str(r.loss)) for r in RP.select_ranks(df, ["k"], targets).collect())
    order = lambda x: (0, 0) if x is None else (2, 0) if math.isnan(x) else (1, x)
    want = []
    for k in ("a", None, "tied"):
        held = sorted((x for j, x in data if j == k), key=order, reverse=True)
        want += [(str(k), r, str(held[r - 1])) for r in ranks if r <= len(held)]
    clean = lambda x: [(k, r, v.replace("-0.0", "0.0") if v == "-0.0" else v) for k, r, v in x]
    assert clean(got) == clean(sorted(want))


def test_report_sorts_no_years(spark):
    main, dial = _long_frames(spark, [D1, D2])
    plan = RP_plan(spark, main, dial)
    # windows run over value ranges and over the distinct values of single ranges
    assert plan.count("Window ") and "_range" in plan and "row_number" not in plan


def RP_plan(spark, main, dial):
    from catloss.operators import report as RP
    return RP.ep_report(main, dial, RunParams(), order=False)._jdf.queryExecution().optimizedPlan().toString()


def test_report_rows_are_in_report_order(spark):
    from catloss.operators import report as RP
    from tests.test_streams import bridge_frames
    got = [tuple(r) for r in bridge_frames(spark).ep_report().select(*RP.REPORT_ORDER).collect()]
    assert len(got) > 50 and got == sorted(got, key=lambda r: tuple((x is not None, x) for x in r))
