"""Dialsup stream: unblended losses with FX and forecast factors.

``factor_base`` + ``dialsup_metric`` follow the reference; ``dialsup_metric_stream``
emits the three metrics in one pass from ranked rows that carry the ``_cat``
catalogue array (shared with the main stream).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catloss import schemas as SC
from catloss.functions.exprs import ieee_div
from catloss.functions.joins import bounded_broadcast
from catloss.operators import lookups as LK
from catloss.operators.main_stream import level

DIALSUP_STAGES = ("dialsup_original", "dialsup_localccy", "dialsup_localccy_forecast")
FINAL_DIALSUP_METRIC = "dialsup_localccy_forecast"


def factor_base(
    ranked: DataFrame, verisk_events: DataFrame, fx: DataFrame, dates: DataFrame, factors: DataFrame
) -> DataFrame:
    """Catalogue (left), FX (inner), every forecast date, forecast factor (left, missing -> 1.0)."""
    out = (
        ranked.join(verisk_events, ["event_id", "year_id", "model_code"], "left")
        .join(bounded_broadcast(fx), "currency", "inner")
        .crossJoin(bounded_broadcast(dates))
        .join(bounded_broadcast(factors), ["class", "office", "forecast_date"], "left")
        .withColumn("_forecast_factor", F.coalesce(F.col("_forecast_factor_raw"), F.lit(1.0)))
    )
    return SC.conform(out, SC.DIALSUP_FACTOR_BASE)


def dialsup_metric(base: DataFrame, metric: str) -> DataFrame:
    """One of the three dialsup metrics from the factor base."""
    if metric == "dialsup_original":
        out = base
    elif metric == "dialsup_localccy":
        out = base.withColumn("loss", ieee_div("loss", "fx_rate")).withColumn("target_currency", F.col("currency"))
    elif metric == "dialsup_localccy_forecast":
        out = base.withColumn(
            "loss", ieee_div("loss", "fx_rate") * F.col("_forecast_factor")
        ).withColumn("target_currency", F.col("currency"))
    else:
        raise ValueError(f"unknown dialsup metric {metric!r}")
    return SC.conform(out.withColumn("metric", F.lit(metric)), SC.DIALSUP_METRIC)


def union_dialsup(*metrics: DataFrame) -> DataFrame:
    """U4: bag union of the three metric frames."""
    out = metrics[0]
    for m in metrics[1:]:
        out = out.unionByName(m)
    return SC.conform(out, SC.DIALSUP_METRIC)


def dialsup_metric_stream(
    ranked_with_catalogue: DataFrame,
    fx: DataFrame,
    dates: DataFrame,
    factors: DataFrame,
    stages: tuple[str, ...] = DIALSUP_STAGES,
    single: frozenset[str] = frozenset(),
) -> DataFrame:
    """The three dialsup metrics in one pass (same rows as the union of ``dialsup_metric``).

    Catalogue matches (left), FX rates (inner), forecast dates and factors are levels of one
    row a match (``main_stream.level``); each leaf row emits the metrics. ``single`` names the
    lookups known to hold one match a key at most.
    """
    base_cols = [c for c in SC.names(SC.YLT_RANKED) if c not in ("loss", "metric")]
    extra = [c for c in ranked_with_catalogue.columns if c not in SC.names(SC.YLT_RANKED) and c != "_cat"]
    x = ranked_with_catalogue.join(LK.fx_lookup(fx), "currency", "inner").crossJoin(LK.dates_lookup(dates))
    keep = [*base_cols, *extra, "loss", "_fx", "_dates"]
    x = level(
        x, keep, F.coalesce(F.col("_cat"), LK.no_catalogue_match()), "_cp", "catalogue" in single,
        model_event_id=lambda c: c.model_event_id, event_day=lambda c: c.event_day)
    keep = [k for k in keep if k != "_fx"] + ["model_event_id", "event_day"]
    x = level(
        x, [*keep, "_dates"], F.col("_fx"), "_fp", "fx" in single,
        _fx_tc=lambda f: f.target_currency, fx_rate_date=lambda f: f.fx_rate_date, fx_rate=lambda f: f.fx_rate)
    keep = [k for k in keep if k != "_dates"] + ["_fx_tc", "fx_rate_date", "fx_rate"]
    x = x.select(*keep, F.explode("_dates").alias("forecast_date"))
    keep = [*keep, "forecast_date"]
    x = x.join(LK.factors_lookup(factors, date_col="forecast_date"), ["class", "office", "forecast_date"], "left")
    x = level(x, keep, F.col("_ff"), "_gp", "factors" in single, _g=lambda g: g)
    factor = F.coalesce(F.col("_g"), F.lit(1.0))
    local = ieee_div("loss", "fx_rate")

    def stage(metric: str, loss: F.Column, ccy: F.Column) -> F.Column:
        return F.struct(F.lit(metric).alias("metric"), loss.cast("double").alias("loss"), ccy.alias("target_currency"))

    emit = {
        "dialsup_original": stage("dialsup_original", F.col("loss"), F.col("_fx_tc")),
        "dialsup_localccy": stage("dialsup_localccy", local, F.col("currency")),
        "dialsup_localccy_forecast": stage("dialsup_localccy_forecast", local * factor, F.col("currency")),
    }
    chosen = [s for name, s in emit.items() if name in stages]
    out_keep = [k for k in keep if k not in ("loss", "_fx_tc")]
    if len(chosen) == 1:
        out = x.select(*out_keep, chosen[0].alias("_s")).select(*out_keep, "_s.*")
    else:
        out = x.select(*out_keep, F.inline(F.array(*chosen)))
    return out.select(*[F.col(fl.name).cast(fl.dataType) for fl in SC.DIALSUP_METRIC.fields], *extra)
