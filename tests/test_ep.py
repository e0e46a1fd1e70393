"""EP branch: peril selection and blending targets (worked examples U1-U4)."""

import pytest

from catloss import schemas as SC
from catloss.operators import ep as EP
from catloss.params import RunParams, TargetPoint
from tests.conftest import rows


def _enriched(spark, perils):
    recs = [
        dict(vendor="verisk", analysis_id="a", modelled_lob="L", modelled_peril=p, ep_type="AAL", return_period=0,
             loss=1.0, rollup_lob="RL", rollup_peril="WS", region_peril_id=1, blend_subregion_peril_id="1a",
             base_model="verisk", selection_priority=prio, is_dialsup=dial, is_euws=0)
        for p, prio, dial in perils
    ]
    return rows(spark, SC.EP_ENRICHED, recs)


def test_u1_lowest_priority_wins_and_all_dialsup_kept(spark):
    enriched = _enriched(spark, [("HIGH", 20, 0), ("LOW", 10, 0), ("DIAL_A", 30, 1), ("DIAL_B", 40, 1)])
    main = {r.modelled_peril for r in EP.select_main_perils(enriched).collect()}
    dial = {r.modelled_peril for r in EP.select_dialsup_perils(enriched).collect()}
    assert main == {"LOW"}
    assert dial == {"DIAL_A", "DIAL_B"}


def test_priority_tie_goes_to_first_peril(spark):
    enriched = _enriched(spark, [("ZED", 1, 0), ("ALPHA", 1, 0)])
    assert {r.modelled_peril for r in EP.select_main_perils(enriched).collect()} == {"ALPHA"}


def _points(spark, rl, vk, base="risklink", ep_type="AAL", rp=0):
    return rows(spark, SC.EP_VENDOR_JOINED, [dict(
        rollup_lob="RL", rollup_peril="FL", region_peril_id=216, blend_subregion_peril_id="216b",
        base_model=base, ep_type=ep_type, return_period=rp, risklink_loss=rl, verisk_loss=vk)])


def _weights(spark, vk_w=0.25, rl_w=0.75):
    return rows(spark, SC.WEIGHTS, [dict(region_peril_id=216, blend_subregion_peril_id="216b",
                                         sub_region_peril="x", verisk_weight=vk_w, risklink_weight=rl_w)])


def test_u2_both_vendors_blend(spark):
    t = EP.blending_targets(_points(spark, 200.0, 100.0), _weights(spark), RunParams()).first()
    assert (t.risklink_blended_contribution, t.verisk_blended_contribution) == (150.0, 25.0)
    assert t.target_loss == 175.0
    assert t.uplift_factor_on_base_model == pytest.approx(0.875)


def test_u3_single_vendor_keeps_base(spark):
    t = EP.blending_targets(_points(spark, 200.0, None), _weights(spark), RunParams()).first()
    assert t.target_loss == 200.0 and t.uplift_factor_on_base_model == 1.0
    assert (t.risklink_blended_contribution, t.verisk_blended_contribution) == (200.0, 0.0)


def test_missing_base_loss_drops_point(spark):
    assert EP.blending_targets(_points(spark, None, 100.0), _weights(spark), RunParams()).count() == 0


def test_u4_uplift_clipped_to_configured_max(spark):
    params = RunParams(vendor_years={"verisk": 4}, uplift_max=2.0,
                       target_points=(TargetPoint("AAL", 0), TargetPoint("OEP", 2)))
    t = EP.blending_targets(_points(spark, 400.0, 100.0, base="verisk", ep_type="OEP", rp=2),
                            _weights(spark, vk_w=0.0, rl_w=1.0), params).first()
    assert t.uplift_factor_on_base_model == 2.0


def test_vendor_join_full_outer_semantics(spark):
    recs = [
        dict(vendor="risklink", rollup_lob="A", rollup_peril="P", region_peril_id=1, blend_subregion_peril_id="x",
             base_model="risklink", ep_type="AAL", return_period=0, loss=2.0),
        dict(vendor="verisk", rollup_lob="A", rollup_peril="P", region_peril_id=1, blend_subregion_peril_id="x",
             base_model="risklink", ep_type="AAL", return_period=0, loss=3.0),
        dict(vendor="verisk", rollup_lob="A", rollup_peril="P", region_peril_id=1, blend_subregion_peril_id="x",
             base_model="risklink", ep_type="OEP", return_period=200, loss=None),
        dict(vendor="verisk", rollup_lob=None, rollup_peril="P", region_peril_id=1, blend_subregion_peril_id="x",
             base_model="risklink", ep_type="AAL", return_period=0, loss=5.0),
        dict(vendor="risklink", rollup_lob=None, rollup_peril="P", region_peril_id=1, blend_subregion_peril_id="x",
             base_model="risklink", ep_type="AAL", return_period=0, loss=7.0),
    ]
    out = sorted(((r.rollup_lob, r.ep_type, r.risklink_loss, r.verisk_loss)
                  for r in EP.vendor_joined(rows(spark, SC.EP_ENRICHED, recs)).collect()), key=str)
    # null keys never match: the two null-lob rows stay apart; an all-null group sums to 0.0
    assert out == sorted([("A", "AAL", 2.0, 3.0), ("A", "OEP", None, 0.0),
                          (None, "AAL", 7.0, None), (None, "AAL", None, 5.0)], key=str)


def _cells(spark, n=400):
    """EP rows of both vendors with one cell that holds a third of them, tied and null priorities, and null keys."""
    recs = []
    for i in range(n):
        cell = 0 if i % 3 == 0 else i % 11
        peril = f"P{i % 5}" if i % 17 else None
        recs.append(dict(
            vendor="verisk" if i % 2 else "risklink", analysis_id=str(i), modelled_lob=f"L{cell}", modelled_peril=peril, ep_type=("AAL", "OEP")[i % 2 == i % 4], return_period=(0, 200)[i % 7 == 0],
            loss=None if i % 13 == 0 else float(i), rollup_lob=None if i % 29 == 0 else f"R{cell}", rollup_peril=f"Q{cell % 2}", region_peril_id=cell % 3 or None,
            blend_subregion_peril_id="a", base_model="verisk" if i % 5 else None, selection_priority=(99, 1, 2, 1, 99)[i % 5], is_dialsup=i % 2, is_euws=0))
    return rows(spark, SC.EP_ENRICHED, recs)


def test_winners_by_cell_equal_winners_by_row(spark):
    enriched = _cells(spark).repartition(5)
    by_row = EP.vendor_joined(EP.select_main_perils(enriched))
    by_cell = EP.vendor_joined(EP.winning_losses(EP.cell_losses(enriched)))
    assert by_row.count() > 20 and sorted(map(str, by_row.collect())) == sorted(map(str, by_cell.collect()))


def test_vendors_are_aligned_within_one_partitioning(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = EP.vendor_joined(EP.winning_losses(EP.cell_losses(_cells(spark))))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    exchanges = [x for x in plan.splitlines() if "Exchange " in x]
    # the map-side sums' exchange, then one by cell for choice and alignment; no join
    assert len(exchanges) == 2 and "hashpartitioning(rollup_lob" in exchanges[0] and "REPARTITION_BY_COL" in exchanges[0] and "Join" not in plan
