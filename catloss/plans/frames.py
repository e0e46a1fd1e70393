"""Every model of a run as lazily built, shared DataFrames.

``RunFrames`` wires the operators in dependency order. Each property builds
its frame once; frames used by several consumers are derived from one ranked
table (all asked streams are ranked in a single pass and written by stream), so
queries and the full run share the same plan pieces.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catloss import schemas as SC
from catloss.inputs import RunInputs
from catloss.operators import dialsup as DS
from catloss.operators import ep as EP
from catloss.operators import lookups as LK
from catloss.operators import main_stream as MS
from catloss.operators import marts as MT
from catloss.operators import report as RP
from catloss.operators import staging as ST
from catloss.operators import wide as WD
from catloss.operators import ylt as YL
from catloss.params import RunParams
from catloss.session import Scratch

STREAMS = ("main", "dialsup")


class RunFrames:
    def __init__(self, inputs: RunInputs, params: RunParams | None = None, streams: tuple[str, ...] = STREAMS):
        """``streams`` are those that may be asked for: no other is ranked."""
        self.inputs = inputs
        self.params = params or RunParams()
        self.streams = streams

    @cached_property
    def scratch(self) -> Scratch:
        return Scratch(self.inputs.ep_summaries.sparkSession)

    def close(self) -> None:
        """Remove the intermediate tables; frames that read them can't be used any more."""
        if "scratch" in self.__dict__:
            self.scratch.close()

    # --- staging ---------------------------------------------------------------
    @cached_property
    def stg_verisk_ylt(self) -> DataFrame:
        return ST.stage_verisk_ylt(self.inputs.ylts["verisk"])

    @cached_property
    def stg_risklink_ylt(self) -> DataFrame:
        return ST.stage_risklink_ylt(self.inputs.ylts["risklink"])

    @cached_property
    def normalized(self) -> DataFrame:
        return ST.normalize_ylt(self.stg_verisk_ylt, self.stg_risklink_ylt)

    @cached_property
    def verisk_events(self) -> DataFrame:
        return ST.stage_verisk_events(self.inputs.seed("verisk_events"))

    @cached_property
    def risklink_events(self) -> DataFrame:
        return ST.stage_risklink_events(self.inputs.seed("risklink_flood22_model_events"))

    @cached_property
    def risklink_catalogue_small(self) -> bool:
        """Size check on the raw flood catalogue (bounds the staged one, no aggregation)."""
        from catloss.functions.joins import is_bounded

        return is_bounded(self.inputs.seed("risklink_flood22_model_events"))

    @cached_property
    def fx(self) -> DataFrame:
        return ST.stage_fx(self.inputs.seed("fx_rates"))

    @cached_property
    def forecast_factors(self) -> DataFrame:
        return ST.stage_forecast_factors(self.inputs.seed("forecast_factors"))

    @cached_property
    def forecast_dates(self) -> DataFrame:
        return ST.forecast_dates(self.forecast_factors)

    @cached_property
    def candidate_dates(self) -> list[str]:
        """The dates that forecast rows can have, as text."""
        return WD.candidate_dates(self.forecast_dates)

    @cached_property
    def euws_factors(self) -> DataFrame:
        return self.inputs.seed("euws_rate_factors")

    @cached_property
    def overrides(self) -> DataFrame:
        return self.inputs.seed("euws_rank_overrides")

    # --- EP branch -------------------------------------------------------------
    @cached_property
    def ep(self) -> dict[str, DataFrame]:
        return EP.ep_branch(self.inputs, self.params)

    def ep_selected(self, stream: str) -> DataFrame:
        return self.ep["ep_selected_main" if stream == "main" else "ep_selected_dialsup"]

    # --- YLT branch ------------------------------------------------------------
    def enriched(self, stream: str = "main") -> DataFrame:
        return YL.enrich_ylt(self.normalized, self.ep_selected(stream))

    def base_selected(self, stream: str = "main") -> DataFrame:
        return YL.select_base_rows(self.enriched(stream), self.params)

    @cached_property
    def dimensions(self) -> DataFrame:
        return YL.dimension_rows({s: self.ep_selected(s) for s in self.streams}, self.scratch.write)

    @cached_property
    def catalogue(self) -> tuple[DataFrame, bool]:
        return LK.written_catalogue(self.verisk_events, self.euws_factors, self.scratch.write)

    @cached_property
    def scored(self) -> DataFrame:
        """All asked streams' base rows, ranked in one pass and written by stream as narrow rows.

        Dimensions and the catalogue's matches are joined when they are read. A catalogue
        beyond the broadcast bound is joined before the ranking instead, once for all readers.
        """
        narrow = YL.narrow_rows(self.normalized, self.dimensions, self.params)
        cat, small = self.catalogue
        return YL.rank_narrow(narrow if small else LK.join_catalogue(narrow, cat), self.params, self.scratch.write)

    def _ranked(self, stream: str, *carry: str) -> DataFrame:
        if stream not in self.streams:
            raise ValueError(f"stream {stream!r} is not among those ranked: {self.streams}")
        return YL.widen(self.scored.where(F.col("_stream") == stream), self.dimensions, self.params, carry).drop("_stream")

    def ranked_with_catalogue(self, stream: str) -> DataFrame:
        cat, small = self.catalogue
        return self._ranked(stream).join(F.broadcast(cat), LK.CAT_KEYS, "left") if small else self._ranked(stream, "_cat")

    def ranked(self, stream: str = "main") -> DataFrame:
        return SC.conform(self._ranked(stream), SC.YLT_RANKED)

    def ranked_single(self, stream: str = "main", strategy: str | None = None) -> DataFrame:
        """One stream ranked on its own (used to cross-check the shared ranking)."""
        return YL.rank_events(self.base_selected(stream), self.params, strategy=strategy)

    # --- main stream: reference-shaped stages -------------------------------------
    @cached_property
    def targets(self) -> DataFrame:
        return self.ep["ep_blending_targets"]

    @cached_property
    def blended(self) -> DataFrame:
        return MS.blend(self.ranked("main"), self.targets)

    @cached_property
    def localccy(self) -> DataFrame:
        return MS.to_local_currency(self.blended, self.fx)

    @cached_property
    def forecasted(self) -> DataFrame:
        return MS.forecast(self.localccy, self.forecast_dates, self.forecast_factors)

    @cached_property
    def euws(self) -> DataFrame:
        return MS.event_factor(self.forecasted, self.verisk_events, self.euws_factors)

    @cached_property
    def euws_override(self) -> DataFrame:
        return MS.rank_override(self.euws, self.overrides)

    @cached_property
    def single_lookups(self) -> frozenset[str]:
        return LK.single_lookups(self.targets, self.fx, self.forecast_factors, self.overrides, self.catalogue[0])

    # --- fused streams ---------------------------------------------------------------
    @cached_property
    def main_stream(self) -> DataFrame:
        return MS.main_metric_stream(
            self.ranked_with_catalogue("main"), self.targets, self.fx, self.forecast_dates,
            self.forecast_factors, self.overrides, single=self.single_lookups,
        )

    @cached_property
    def dialsup_factor_base(self) -> DataFrame:
        return DS.factor_base(
            self.ranked("dialsup"), self.verisk_events, self.fx, self.forecast_dates, self.forecast_factors
        )

    @cached_property
    def dialsup_stream(self) -> DataFrame:
        return DS.dialsup_metric_stream(
            self.ranked_with_catalogue("dialsup"), self.fx, self.forecast_dates, self.forecast_factors, single=self.single_lookups,
        )

    # --- marts -------------------------------------------------------------------------
    @cached_property
    def main_long(self) -> DataFrame:
        return MT.main_long(self.main_stream, self.params.threshold)

    @cached_property
    def dialsup_long(self) -> DataFrame:
        """Only the published dialsup metric is generated (the mart keeps no other)."""
        final_only = DS.dialsup_metric_stream(
            self.ranked_with_catalogue("dialsup"), self.fx, self.forecast_dates, self.forecast_factors,
            stages=(DS.FINAL_DIALSUP_METRIC,), single=self.single_lookups,
        )
        return MT.dialsup_long(final_only, self.params.threshold)

    @cached_property
    def main_final_long(self) -> DataFrame:
        """The published main rows (final metric only) without generating audit stages;
        equal to ``main_long`` filtered on the final metric."""
        final_only = MS.main_metric_stream(
            self.ranked_with_catalogue("main"), self.targets, self.fx, self.forecast_dates,
            self.forecast_factors, self.overrides, stages=(MS.FINAL_MAIN_METRIC,), single=self.single_lookups,
        )
        return MT.main_long(final_only, self.params.threshold)

    @cached_property
    def main_fanout(self) -> DataFrame:
        return MT.main_fanout(self.main_final_long, self.risklink_events, self.risklink_catalogue_small)

    @cached_property
    def dialsup_fanout(self) -> DataFrame:
        return MT.dialsup_fanout(self.dialsup_long, self.risklink_events, self.risklink_catalogue_small)

    @cached_property
    def event_validation(self) -> DataFrame:
        return MT.event_validation(self.main_fanout, self.dialsup_fanout)

    @cached_property
    def wide_source(self) -> DataFrame:
        return WD.wide_source(self.main_final_long, self.dialsup_long)

    def wide_output(self, check_grain: bool = True) -> DataFrame:
        return WD.wide_output(self.main_final_long, self.dialsup_long, self.candidate_dates, check_grain)

    @cached_property
    def report_annual(self) -> DataFrame:
        return RP.annual(RP.report_losses(self.main_final_long, self.dialsup_long, self.params))

    def ep_report(self, order: bool = True) -> DataFrame:
        return RP.ep_report(self.main_final_long, self.dialsup_long, self.params, order=order, write=self.scratch.write)

    # --- debug layers (W6) ---------------------------------------------------------
    def debug_layers(self) -> dict[str, dict[str, DataFrame]]:
        """Every model by layer prefix (``src seed stg int mts``), for the opt-in debug dump."""
        base = self.dialsup_factor_base
        return {
            "src": {"ep_summaries": self.inputs.ep_summaries},
            "seed": dict(self.inputs.seeds),
            "stg": {
                "forecast_factors": self.forecast_factors,
                "gbp_fx_rates": self.fx,
                "risklink_flood_events": self.risklink_events,
                "risklink_ylt": self.stg_risklink_ylt,
                "verisk_events": self.verisk_events,
                "verisk_ylt": self.stg_verisk_ylt,
            },
            "int": {
                "ep_blending_target_points": self.ep["ep_target_points"],
                "ep_blending_targets": self.targets,
                "ep_blending_weights": self.ep["blend_weights"],
                "ep_summaries_dialsup": self.ep["ep_selected_dialsup"],
                "ep_summaries_enriched": self.ep["ep_enriched"],
                "ep_summaries_main": self.ep["ep_selected_main"],
                "ep_vendor_joined": self.ep["ep_vendor_joined"],
                "forecast_dates": self.forecast_dates,
                "ylt_dialsup_base_selected": self.base_selected("dialsup"),
                "ylt_dialsup_enriched": self.enriched("dialsup"),
                "ylt_dialsup_factor_base": base,
                "ylt_dialsup_forecast_metric": DS.dialsup_metric(base, "dialsup_localccy_forecast"),
                "ylt_dialsup_local_currency_metric": DS.dialsup_metric(base, "dialsup_localccy"),
                "ylt_dialsup_metric_stream": self.dialsup_stream,
                "ylt_dialsup_original_metric": DS.dialsup_metric(base, "dialsup_original"),
                "ylt_dialsup_ranked": self.ranked("dialsup"),
                "ylt_main_base_selected": self.base_selected("main"),
                "ylt_main_blended": self.blended,
                "ylt_main_enriched": self.enriched("main"),
                "ylt_main_euws": self.euws,
                "ylt_main_euws_override": self.euws_override,
                "ylt_main_forecast": self.forecasted,
                "ylt_main_local_currency": self.localccy,
                "ylt_main_metric_stream": self.main_stream,
                "ylt_main_ranked": self.ranked("main"),
                "ylt_normalized": self.normalized,
            },
            "mts": {
                "dialsup_fanout": self.dialsup_fanout,
                "event_validation": self.event_validation,
                "main_fanout": self.main_fanout,
                "ylt_dialsup_long": self.dialsup_long,
                "ylt_main_long": self.main_long,
            },
        }
