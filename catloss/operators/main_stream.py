"""Main (blended) stream: blend -> local currency -> forecast dates -> event factor -> override.

Two forms with the same multiset of rows:

* the stage operators (``blend`` ... ``rank_override``) and ``union_stages`` follow
  the reference step by step; each stage is its own frame;
* ``main_metric_stream`` computes all six stages in a single pass over the
  ranked rows: lookups are attached as arrays, exploded level by level, and every
  leaf row emits the stage rows it owns. Nothing is recomputed per stage and the
  forecast-date expansion happens after every row-reducing step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catloss import schemas as SC
from catloss.functions.exprs import ieee_div
from catloss.functions.joins import bounded_broadcast
from catloss.operators import lookups as LK

BLEND_KEYS = ["rollup_lob", "rollup_peril", "region_peril_id", "blend_subregion_peril_id", "rp_bucket", "base_model"]
MAIN_STAGES = ("original", "blended", "localccy", "localccy_forecast", "euws", "euws_override")
FINAL_MAIN_METRIC = "euws_override"


# --- stage operators (reference shape) ---------------------------------------
def blend(ranked: DataFrame, targets: DataFrame) -> DataFrame:
    """Inner join on 6 keys (bucket = return period); loss *= uplift."""
    factors = targets.select(
        "rollup_lob", "rollup_peril", "region_peril_id", "blend_subregion_peril_id", "base_model",
        F.col("return_period").alias("rp_bucket"), *SC.WIDE_DIAGNOSTICS,
    )
    out = (
        ranked.join(bounded_broadcast(factors), BLEND_KEYS, "inner")
        .withColumn("loss", F.col("loss") * F.col("uplift_factor_on_base_model"))
        .withColumn("metric", F.lit("blended"))
    )
    return SC.conform(out, SC.YLT_BLENDED)


def to_local_currency(blended: DataFrame, fx: DataFrame) -> DataFrame:
    """Inner join on currency (missing rate drops; several rates multiply); loss /= rate."""
    out = (
        blended.join(bounded_broadcast(fx.drop("target_currency")), "currency", "inner")
        .withColumn("loss", ieee_div("loss", "fx_rate"))
        .withColumn("target_currency", F.col("currency"))
        .withColumn("metric", F.lit("localccy"))
    )
    return SC.conform(out, SC.YLT_LOCALCCY)


def forecast(localccy: DataFrame, dates: DataFrame, factors: DataFrame) -> DataFrame:
    """B4 / J10 + J11: every forecast date; loss *= factor (missing -> 1.0)."""
    out = (
        localccy.crossJoin(bounded_broadcast(dates))
        .join(bounded_broadcast(factors), ["class", "office", "forecast_date"], "left")
        .withColumn("loss", F.col("loss") * F.coalesce(F.col("_forecast_factor_raw"), F.lit(1.0)))
        .withColumn("metric", F.lit("localccy_forecast"))
    )
    return SC.conform(out, SC.YLT_FORECAST)


def event_factor(forecasted: DataFrame, verisk_events: DataFrame, euws_factors: DataFrame) -> DataFrame:
    """B5 / J12 + J13: catalogue and event rate factor (missing -> 1.0); keeps the pre-factor loss."""
    factors = euws_factors.select("model_event_id", F.col("factor").alias("_src"))
    out = (
        forecasted.join(verisk_events, ["event_id", "year_id", "model_code"], "left")
        .join(factors, "model_event_id", "left")
        .withColumn("_euws_factor_raw", F.coalesce(F.col("_src"), F.lit(1.0)))
        .withColumn("_localccy_forecast_loss", F.col("loss"))
        .withColumn("loss", F.col("loss") * F.col("_euws_factor_raw"))
        .withColumn("metric", F.lit("euws"))
    )
    return SC.conform(out, SC.YLT_EUWS)


def _override_condition(max_rank: F.Column, factor: F.Column) -> F.Column:
    return factor.isNotNull() & (F.col("rnk") <= max_rank) & (F.col("_euws_factor_raw") == 0)


def rank_override(euws: DataFrame, overrides: DataFrame) -> DataFrame:
    """A zero event factor on a top-ranked event is replaced by the lob's override factor."""
    ovr = overrides.select(
        "rollup_lob", F.col("max_rank").alias("_max_rank"), F.col("factor").alias("_ovr_factor")
    )
    cond = _override_condition(F.col("_max_rank"), F.col("_ovr_factor"))
    out = (
        euws.join(bounded_broadcast(ovr), "rollup_lob", "left")
        .withColumn(
            "loss", F.when(cond, F.col("_localccy_forecast_loss") * F.col("_ovr_factor")).otherwise(F.col("loss"))
        )
        .withColumn("metric", F.lit(FINAL_MAIN_METRIC))
    )
    return SC.conform(out, SC.YLT_EUWS)


def union_stages(*stages: DataFrame) -> DataFrame:
    """U3 in reference form: bag union, missing columns null."""
    out = stages[0]
    for s in stages[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return SC.conform(out, SC.MAIN_STREAM)


# --- fused stream --------------------------------------------------------------
def level(x: DataFrame, keep: list[str], arr: F.Column, pos: str, single: bool, **fields) -> DataFrame:
    """One row per match in ``arr``: columns ``keep``, the match's position and ``fields``; without a match one row of nulls.

    Where the lookup holds one match a key at most (``single``), that is a projection;
    else the matches are exploded.
    """
    if not single:
        matches = x.select(*keep, F.posexplode_outer(arr).alias(pos, "_match"))
        return matches.select(*keep, pos, *[fn(F.col("_match")).alias(n) for n, fn in fields.items()])
    match = F.get(arr, F.lit(0))
    return x.select(*keep, F.when(F.size(arr) > 0, F.lit(0)).alias(pos), *[fn(match).alias(n) for n, fn in fields.items()])


POSITIONS = ("_tp", "_fp", "_dp", "_gp", "_cp", "_ep", "_op")


def _of_stage(place: F.Column, values: dict[str, F.Column]) -> F.Column:
    """The value of the stage whose place in MAIN_STAGES is ``place``."""
    out = None
    for metric, value in values.items():
        hit = place == MAIN_STAGES.index(metric)
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out


def main_metric_stream(
    ranked_with_catalogue: DataFrame,
    targets: DataFrame,
    fx: DataFrame,
    dates: DataFrame,
    factors: DataFrame,
    overrides: DataFrame,
    stages: tuple[str, ...] = MAIN_STAGES,
    single: frozenset[str] = frozenset(),
) -> DataFrame:
    """All main stages from ranked rows that carry the ``_cat`` catalogue array.

    Explode order and what each level emits (a row emits a parent stage only at
    position 0 of every deeper level, so each stage row appears exactly once):
    targets -> original/blended; fx rates -> localccy; forecast dates x factor rows
    -> localccy_forecast; catalogue matches x euws factors -> euws; overrides ->
    euws_override. ``stages`` limits which metrics are emitted. ``single`` names the lookups
    known to hold one match a key at most (``lookups.single_lookups``), which need no explode.
    """
    base_cols = [c for c in SC.names(SC.YLT_RANKED) if c not in ("loss", "metric")]
    extra = [c for c in ranked_with_catalogue.columns if c not in SC.names(SC.YLT_RANKED) and c != "_cat"]
    x = (
        ranked_with_catalogue.join(LK.targets_lookup(targets), BLEND_KEYS, "left")
        .join(LK.fx_lookup(fx), "currency", "left")
        .join(LK.overrides_lookup(overrides), "rollup_lob", "left")
        .crossJoin(LK.dates_lookup(dates))
    )
    keep = [*base_cols, *extra, "loss", "_cat", "_fx", "_ovr", "_dates"]
    x = level(
        x, keep, F.col("_targets"), "_tp", "targets" in single,
        _t_rl=lambda t: t.risklink_blended_contribution, _t_vk=lambda t: t.verisk_blended_contribution, _t_up=lambda t: t.uplift_factor_on_base_model)
    keep = [*keep, "_tp", "_t_rl", "_t_vk", "_t_up"]
    x = level(x, keep, F.when(F.col("_tp").isNotNull(), F.col("_fx")), "_fp", "fx" in single, _fx_rate=lambda f: f.fx_rate)
    keep = [k for k in keep if k != "_fx"] + ["_fp", "_fx_rate"]
    x = level(x, keep, F.when(F.col("_fp").isNotNull(), F.col("_dates")), "_dp", False, _d=lambda d: d)
    keep = [k for k in keep if k != "_dates"] + ["_dp", "_d"]
    x = x.join(LK.factors_lookup(factors), ["class", "office", "_d"], "left")
    has_date = F.col("_dp").isNotNull()
    x = level(x, keep, F.when(has_date, F.col("_ff")), "_gp", "factors" in single, _g=lambda g: g)
    keep = [*keep, "_gp", "_g"]
    x = level(
        x, keep, F.when(has_date, F.coalesce(F.col("_cat"), LK.no_catalogue_match())), "_cp", "catalogue" in single,
        _c_event=lambda c: c.model_event_id, _c_day=lambda c: c.event_day, _c_factors=lambda c: c.factors)
    keep = [k for k in keep if k != "_cat"] + ["_cp", "_c_event", "_c_day", "_c_factors"]
    x = level(x, keep, F.when(has_date, F.col("_c_factors")), "_ep", "event_factors" in single, _e=lambda e: e)
    keep = [k for k in keep if k != "_c_factors"] + ["_ep", "_e"]
    x = level(
        x, keep, F.when(has_date, F.col("_ovr")), "_op", "overrides" in single, _o_max=lambda o: o.max_rank, _o_factor=lambda o: o.factor)

    # one projection after the other, so that no value is worked out again inside the next
    ovr_cond = F.col("_o_factor").isNotNull() & (F.col("rnk") <= F.col("_o_max")) & (F.col("_raw") == 0)
    x = x.withColumns({"_blended": F.col("loss") * F.col("_t_up"), "_raw": F.coalesce(F.col("_e"), F.lit(1.0))})
    x = x.withColumn("_local", ieee_div("_blended", "_fx_rate"))
    x = x.withColumn("_fc", F.col("_local") * F.coalesce(F.col("_g"), F.lit(1.0)))
    x = x.withColumn("_euws", F.col("_fc") * F.col("_raw"))
    leaf = x.withColumn("_final", F.when(ovr_cond, F.col("_fc") * F.col("_o_factor")).otherwise(F.col("_euws")))
    emit = {
        "original": (LK.first_or_none("_tp", "_fp", "_dp", "_gp", "_cp", "_ep", "_op"), "loss"),
        "blended": (F.col("_tp").isNotNull() & LK.first_or_none("_fp", "_dp", "_gp", "_cp", "_ep", "_op"), "_blended"),
        "localccy": (F.col("_fp").isNotNull() & LK.first_or_none("_dp", "_gp", "_cp", "_ep", "_op"), "_local"),
        "localccy_forecast": (has_date & LK.first_or_none("_cp", "_ep", "_op"), "_fc"),
        "euws": (has_date & LK.first_or_none("_op"), "_euws"),
        "euws_override": (has_date, "_final"),
    }
    chosen = [m for m in MAIN_STAGES if m in stages]
    # A leaf times the stages' places, then a filter: plain columns that compile, where an
    # array of the stages' rows, filtered by a lambda, would be interpreted for every leaf.
    place = F.col("_s") if len(chosen) > 1 else F.lit(MAIN_STAGES.index(chosen[0]))
    if len(chosen) > 1:
        leaf = leaf.select("*", F.explode(F.array(*[F.lit(MAIN_STAGES.index(m)) for m in chosen])).alias("_s"))
    leaf = leaf.where(_of_stage(place, {m: emit[m][0] for m in chosen}))
    since = lambda metric, c: F.when(place >= MAIN_STAGES.index(metric), F.col(c))  # noqa: E731  (null in the stages before)
    made = {
        "metric": _of_stage(place, {m: F.lit(m) for m in chosen}),
        "loss": _of_stage(place, {m: F.col(emit[m][1]) for m in chosen}),
        "risklink_blended_contribution": since("blended", "_t_rl"),
        "verisk_blended_contribution": since("blended", "_t_vk"),
        "uplift_factor_on_base_model": since("blended", "_t_up"),
        "target_currency": since("localccy", "currency"),
        "forecast_date": since("localccy_forecast", "_d"),
        "model_event_id": since("euws", "_c_event"),
        "event_day": since("euws", "_c_day"),
        "_euws_factor_raw": since("euws", "_raw"),
        "_localccy_forecast_loss": since("euws", "_fc"),
    }
    return leaf.select(*[made.get(fl.name, F.col(fl.name)).cast(fl.dataType).alias(fl.name) for fl in SC.MAIN_STREAM.fields], *extra)
