"""Fused streams equal the reference-shaped stage unions on bridged test data."""

import functools

import pytest

from catloss.operators import dialsup as DS
from catloss.operators import main_stream as MS
from catloss.plans.registry import frames
from tests.conftest import SF_SMALL


@functools.lru_cache(maxsize=1)
def _frames(spark):
    return frames(spark, SF_SMALL)


def bridge_frames(spark):
    return _frames(spark)


def _same(a, b) -> bool:
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_fused_main_stream_equals_stage_union(spark):
    fr = bridge_frames(spark)
    union = MS.union_stages(fr.ranked("main"), fr.blended, fr.localccy, fr.forecasted, fr.euws, fr.euws_override)
    assert _same(fr.main_stream, union)


def test_fused_dialsup_stream_equals_metric_union(spark):
    fr = bridge_frames(spark)
    base = fr.dialsup_factor_base
    union = DS.union_dialsup(*[DS.dialsup_metric(base, m) for m in DS.DIALSUP_STAGES])
    assert _same(fr.dialsup_stream, union)


def test_shared_rank_equals_single_stream_rank(spark):
    fr = bridge_frames(spark)
    for stream in ("main", "dialsup"):
        assert _same(fr.ranked(stream), fr.ranked_single(stream, strategy="window"))


def test_final_only_streams_equal_filtered_full_streams(spark):
    from pyspark.sql import functions as F
    from catloss.operators import marts as MT
    fr = bridge_frames(spark)
    full_main = fr.main_long.where(F.col("metric") == MS.FINAL_MAIN_METRIC)
    assert _same(fr.main_final_long, full_main)
    full_dialsup = MT.dialsup_long(fr.dialsup_stream, fr.params.threshold)
    assert _same(fr.dialsup_long, full_dialsup)


def test_lookups_with_repeats_and_nulls_give_the_same_stream(spark):
    """Fused stream = union of stages where lookups repeat keys, hold nulls, or match nothing."""
    import datetime as dt

    from catloss import schemas as SC
    from catloss.operators import lookups as LK
    from catloss.operators import main_stream as MS
    from tests.conftest import ranked_row, rows

    ranked = rows(spark, SC.YLT_RANKED, [
        ranked_row(event_id=e, rnk=i + 1, rp_bucket=b, currency=c, rollup_lob=lob, office=o, model_code=m)
        for i, (e, b, c, lob, o, m) in enumerate([
            (1, 0, "EUR", "RL0", "DE", 41), (2, 0, "EUR", "RL0", None, 41), (3, 200, "USD", "RL1", "DE", 41), (4, 0, None, "RL0", "DE", 41),
            (5, 0, "EUR", None, "DE", None), (6, 1000, "EUR", "RL0", "DE", 41), (1, 0, "EUR", "RL0", "DE", 41),
        ])])
    target = lambda lob, rp, up: dict(rollup_lob=lob, rollup_peril="Europe_WS", region_peril_id=206, blend_subregion_peril_id="206a", base_model="verisk",
                                      ep_type="OEP", return_period=rp, risklink_blended_contribution=1.0, verisk_blended_contribution=2.0, uplift_factor_on_base_model=up)
    fx = rows(spark, SC.FX, [dict(currency=c, target_currency="GBP", fx_rate_date=d, fx_rate=r) for c, d, r in [("EUR", "a", 0.5), ("EUR", "b", 0.25), (None, "a", 2.0), ("USD", "a", 0.0)]])
    dates = spark.createDataFrame([(dt.date(2026, 1, 1),), (None,), (dt.date(2026, 7, 1),)], SC.FORECAST_DATES)
    factors = rows(spark, SC.FORECAST_FACTORS, [{"class": "HH", "office": o, "forecast_date": d, "_forecast_factor_raw": f}
                                                for o, d, f in [("DE", dt.date(2026, 1, 1), 2.0), ("DE", dt.date(2026, 1, 1), 3.0), ("DE", None, 9.0), (None, dt.date(2026, 7, 1), None)]])
    events = rows(spark, SC.VERISK_EVENTS, [dict(model_event_id=i, model_code=41, event_id=e, year_id=1, event_day=d)
                                            for i, e, d in [(901, 1, 5), (901, 1, 5), (902, 1, 6), (None, 2, 7), (903, 3, None), (904, None, 1)]])
    euws = spark.createDataFrame([(901, 1, 0.0), (901, 1, 0.5), (None, 1, 7.0), (903, 1, None)], SC.SEED_SCHEMAS["euws_rate_factors"])
    overrides = spark.createDataFrame([("RL0", 100, 1.0), ("RL0", 1, None), (None, 5, 2.0)], SC.SEED_SCHEMAS["euws_rank_overrides"])
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    for repeats in (True, False):
        targets = rows(spark, SC.EP_TARGETS, [target("RL0", 0, 2.0), *[target("RL0", 0, 4.0)] * repeats, target("RL1", 200, 0.5), target("RL0", 1000, None)])
        if not repeats:
            fx, factors, overrides = fx.dropDuplicates(["currency"]), factors.dropDuplicates(["class", "office", "forecast_date"]), overrides.dropDuplicates(["rollup_lob"])
            events, euws = events.dropDuplicates(["event_id"]), euws.dropDuplicates(["model_event_id"])
        cat = LK.catalogue_lookup(events.dropna(subset=LK.CAT_KEYS), euws.where("model_event_id is not null"))
        single = LK.single_lookups(targets, fx, factors, overrides, cat)
        assert single == (frozenset() if repeats else frozenset(("targets", "fx", "factors", "overrides", "catalogue", "event_factors")))
        with_cat = LK.join_catalogue(ranked, cat)
        assert same(with_cat, ranked.join(cat, LK.CAT_KEYS, "left").select(*with_cat.columns))
        blended = MS.blend(ranked, targets)
        local = MS.to_local_currency(blended, fx)
        fc = MS.forecast(local, dates, factors)
        eu = MS.event_factor(fc, events, euws)
        union = MS.union_stages(ranked, blended, local, fc, eu, MS.rank_override(eu, overrides))
        fused = MS.main_metric_stream(with_cat, targets, fx, dates, factors, overrides, single=single)
        assert union.count() > 40 and same(fused, union)
        final = MS.main_metric_stream(with_cat, targets, fx, dates, factors, overrides, stages=(MS.FINAL_MAIN_METRIC,), single=single)
        assert same(final, union.where(union.metric == MS.FINAL_MAIN_METRIC))


def test_catalogue_beyond_the_broadcast_bound_gives_the_same_rows(spark, monkeypatch):
    from catloss.operators import lookups as LK
    plain = frames(spark, SF_SMALL, ("main",)).main_long
    monkeypatch.setattr(LK, "is_bounded", lambda df: False)
    fr = frames(spark, SF_SMALL, ("main",))
    shuffled = fr.main_long
    assert not fr.catalogue[1]
    assert plain.exceptAll(shuffled).count() == 0 and shuffled.exceptAll(plain).count() == 0


def test_only_asked_streams_are_ranked_and_scratch_is_removed(spark):
    import os

    from catloss.plans.frames import RunFrames
    fr = RunFrames(bridge_frames(spark).inputs, streams=("main",))
    assert fr.ranked("main").count() > 0 and {r["_stream"] for r in fr.scored.select("_stream").distinct().collect()} == {"main"}
    with pytest.raises(ValueError, match="not among those ranked"):
        fr.ranked("dialsup")
    folder = fr.scratch.folder.removeprefix("file:")
    assert os.path.isdir(folder)
    fr.close()
    assert not os.path.exists(folder)


def test_stages_are_emitted_without_lambdas(spark):
    """Lambdas over arrays are interpreted for every row; the streams of big tables must compile."""
    fr = bridge_frames(spark)
    for df in (fr.main_stream, fr.dialsup_stream, fr.main_long):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "lambdafunction" not in plan and "filter(array" not in plan
