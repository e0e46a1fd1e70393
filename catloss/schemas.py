"""Ordered output contracts for every model, checked from the plan (no job)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

S, L, I, D, DT = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.DateType()


def struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


def names(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields]


class SchemaMismatch(ValueError):
    pass


def assert_schema(df: DataFrame, expected: T.StructType, model: str) -> DataFrame:
    """Raise unless ``df`` has exactly the expected ordered names and types."""
    got = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(f.name, f.dataType) for f in expected.fields]
    if got != want:
        raise SchemaMismatch(f"{model}: output schema mismatch: expected {want}, got {got}")
    return df


def conform(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Project and cast ``df`` to the ordered contract."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in expected.fields])


# --- raw inputs -------------------------------------------------------------
RAW_VERISK_YLT = struct(
    ("Analysis", S), ("ExposureAttribute", S), ("CatalogTypeCode", S), ("EventID", L),
    ("ModelCode", L), ("YearID", L), ("GroundUpLoss", D),
)
RAW_RISKLINK_YLT = struct(("anlsid", L), ("yearid", L), ("eventid", L), ("loss", D))
EP_LONG = struct(
    ("vendor", S), ("analysis_id", S), ("modelled_lob", S), ("modelled_peril", S),
    ("ep_type", S), ("return_period", L), ("loss", D),
)

# --- staging ----------------------------------------------------------------
YLT_NORMALIZED = struct(
    ("vendor", S), ("analysis_id", S), ("modelled_peril", S), ("modelled_lob", S),
    ("model_code", L), ("year_id", L), ("event_id", L), ("loss", D),
)
VERISK_EVENTS = struct(
    ("model_event_id", L), ("model_code", L), ("event_id", L), ("year_id", L), ("event_day", L)
)
RISKLINK_EVENTS = struct(
    ("event_id", L), ("model_occurrence_year", L), ("region_peril_id", L), ("risklink_event_day", L)
)
FX = struct(("currency", S), ("target_currency", S), ("fx_rate_date", S), ("fx_rate", D))
FORECAST_FACTORS = struct(("class", S), ("office", S), ("forecast_date", DT), ("_forecast_factor_raw", D))
WEIGHTS = struct(
    ("region_peril_id", L), ("blend_subregion_peril_id", S), ("sub_region_peril", S),
    ("verisk_weight", D), ("risklink_weight", D),
)
FORECAST_DATES = struct(("forecast_date", DT))

# --- EP branch --------------------------------------------------------------
EP_DIMENSIONS = (
    ("rollup_lob", S), ("cds_cat_class_name", S), ("class", S), ("office", S), ("currency", S),
    ("rollup_peril", S), ("region", S), ("peril", S), ("region_peril_id", L),
    ("blend_subregion_peril_id", S), ("base_model", S), ("selection_priority", L),
    ("is_dialsup", L), ("is_euws", L),
)
EP_ENRICHED = struct(*[(f.name, f.dataType) for f in EP_LONG.fields], *EP_DIMENSIONS)
EP_JOIN_KEYS = (
    "rollup_lob", "rollup_peril", "region_peril_id", "blend_subregion_peril_id", "base_model",
    "ep_type", "return_period",
)
EP_VENDOR_JOINED = struct(
    ("rollup_lob", S), ("rollup_peril", S), ("region_peril_id", L), ("blend_subregion_peril_id", S),
    ("base_model", S), ("ep_type", S), ("return_period", L), ("risklink_loss", D), ("verisk_loss", D),
)
EP_TARGETS = struct(
    *[(f.name, f.dataType) for f in EP_VENDOR_JOINED.fields],
    ("sub_region_peril", S), ("verisk_weight", D), ("risklink_weight", D), ("base_model_loss", D),
    ("risklink_blended_contribution", D), ("verisk_blended_contribution", D), ("target_loss", D),
    ("uplift_factor_on_base_model", D),
)

# --- YLT branch -------------------------------------------------------------
YLT_ENRICHED = struct(
    ("vendor", S), ("analysis_id", S), ("modelled_lob", S), ("modelled_peril", S),
    ("rollup_lob", S), ("rollup_peril", S), ("region_peril_id", L), ("blend_subregion_peril_id", S),
    ("base_model", S), ("selection_priority", L), ("is_dialsup", L), ("is_euws", L),
    ("cds_cat_class_name", S), ("class", S), ("office", S), ("currency", S),
    ("model_code", L), ("year_id", L), ("event_id", L), ("loss", D),
)
ENRICH_KEY_COLUMNS = (
    "rollup_lob", "rollup_peril", "region_peril_id", "blend_subregion_peril_id", "base_model",
    "selection_priority", "is_dialsup", "is_euws", "cds_cat_class_name", "class", "office",
    "currency",
)
YLT_BASE = struct(*[(f.name, f.dataType) for f in YLT_ENRICHED.fields], ("metric", S))
YLT_RANKED = struct(
    *[(f.name, f.dataType) for f in YLT_BASE.fields], ("rnk", L), ("rp", D), ("rp_bucket", I)
)
DIAGNOSTICS = (
    ("risklink_blended_contribution", D), ("verisk_blended_contribution", D),
    ("uplift_factor_on_base_model", D),
)
YLT_BLENDED = struct(*[(f.name, f.dataType) for f in YLT_RANKED.fields], *DIAGNOSTICS)
YLT_LOCALCCY = struct(*[(f.name, f.dataType) for f in YLT_BLENDED.fields], ("target_currency", S))
YLT_FORECAST = struct(*[(f.name, f.dataType) for f in YLT_LOCALCCY.fields], ("forecast_date", DT))
YLT_EUWS = struct(
    *[(f.name, f.dataType) for f in YLT_FORECAST.fields], ("model_event_id", L), ("event_day", L),
    ("_euws_factor_raw", D), ("_localccy_forecast_loss", D),
)
MAIN_STREAM = YLT_EUWS
MAIN_LONG = struct(*[(f.name, f.dataType) for f in MAIN_STREAM.fields], ("output_use", S))

DIALSUP_METRIC = struct(
    *[(f.name, f.dataType) for f in YLT_RANKED.fields], ("model_event_id", L), ("event_day", L),
    ("target_currency", S), ("fx_rate_date", S), ("fx_rate", D), ("forecast_date", DT),
)
DIALSUP_FACTOR_BASE = struct(
    *[(f.name, f.dataType) for f in DIALSUP_METRIC.fields], ("_forecast_factor_raw", D),
    ("_forecast_factor", D),
)
DIALSUP_LONG = struct(*[(f.name, f.dataType) for f in DIALSUP_METRIC.fields], ("output_use", S))

# --- marts ------------------------------------------------------------------
FANOUT = struct(
    ("forecast_date", DT), ("base_model", S), ("metric", S), ("ModelEventID", L), ("ModelYear", L),
    ("CurrencyCode", S), ("ModelYOA", L), ("ModelGrossLoss", D), ("ModelInwardsReinstatement", L),
    ("ModelEventDay", L), ("LossClassName", S),
)
EVENT_VALIDATION = struct(
    ("base_model", S), ("metric", S), ("forecast_date", DT), ("row_count", L),
    ("missing_model_event_id", L), ("missing_model_event_day", L),
)
WIDE_IDENTITY = (
    "vendor", "analysis_id", "base_model", "model_code", "year_id", "event_id", "model_event_id",
    "event_day", "rollup_lob", "rollup_peril", "modelled_lob", "modelled_peril", "region_peril_id",
    "blend_subregion_peril_id", "cds_cat_class_name", "class", "office", "currency",
    "target_currency", "rnk", "rp", "rp_bucket", "selection_priority", "is_dialsup", "is_euws",
)
WIDE_DIAGNOSTICS = tuple(n for n, _ in DIAGNOSTICS)
EP_REPORT = struct(
    ("forecast_date", DT), ("metric", S), ("ep_type", S), ("return_period", L), ("base_model", S),
    ("rollup_lob", S), ("rollup_peril", S), ("rank", L), ("rp", D), ("loss", D),
)
COVERAGE = struct(
    ("severity", S), ("direction", S), ("source_group", S), ("dimension", S), ("field", S),
    ("path", S), ("value", S), ("count", L), ("message", S), ("error", S),
)
INPUT_AAL = struct(
    ("vendor", S), ("rollup_lob", S), ("rollup_peril", S), ("modelled_lob", S),
    ("modelled_peril", S), ("row_count", L), ("loss_sum", D), ("simulation_count", L),
    ("raw_aal", D),
)

# --- seeds (explicit schemas for CSV reads) ---------------------------------
SEED_SCHEMAS = {
    "lobs": struct(
        ("lob_id", L), ("modelled_lob", S), ("rollup_lob", S), ("lob_type", S),
        ("cds_cat_class_name", S), ("office", S), ("class", S), ("currency", S),
    ),
    "perils": struct(
        ("modelled_peril", S), ("rollup_peril", S), ("region", S), ("peril", S),
        ("region_peril_id", L), ("blend_subregion_peril_id", S), ("base_model", S),
        ("selection_priority", L), ("is_dialsup", L), ("is_euws", L),
    ),
    "blending_factors": struct(
        ("id", L), ("BlendSetID", L), ("RegionPerilID", L), ("RegionPeril", S),
        ("SubRegionPerilID", S), ("SubRegionPeril", S), ("AIRBlend", D), ("RMSBlend", D),
        ("KatRiskBlend", D), ("DateCreated", S),
    ),
    "fx_rates": struct(("currency_code", S), ("target_currency", S), ("rate_date", S), ("rate", D)),
    "forecast_factors": struct(
        ("class", S), ("office", S), ("office_iso2", S), ("forecast_date", S), ("factor", D)
    ),
    "euws_rate_factors": struct(("model_event_id", L), ("occ_year", L), ("factor", D)),
    "euws_rank_overrides": struct(("rollup_lob", S), ("max_rank", L), ("factor", D)),
    "verisk_events": struct(("EventID", L), ("ModelID", L), ("Event", L), ("Year", L), ("Day", L)),
    "risklink_flood22_model_events": struct(
        ("ModelEventID", L), ("ModelOccurrenceYear", L), ("RegionPerilID", L),
        ("ModelOccurrenceDate", T.TimestampNTZType()),
    ),
}
# Fixed value: the nine seed stems a run requires.
REQUIRED_SEED_STEMS = (
    "lobs",
    "perils",
    "verisk_events",
    "risklink_flood22_model_events",
    "fx_rates",
    "forecast_factors",
    "euws_rate_factors",
    "euws_rank_overrides",
    "blending_factors",
)
