"""Staging projections: rename, cast and clean raw inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catloss import schemas as SC
from catloss.functions.exprs import strip_ws


def stage_verisk_ylt(raw: DataFrame) -> DataFrame:
    """Keep catalogue type ``STC`` (whitespace-trimmed); analysis is also the modelled peril."""
    analysis = strip_ws("Analysis")
    out = raw.where(strip_ws("CatalogTypeCode") == F.lit("STC")).select(
        F.lit("verisk").alias("vendor"),
        analysis.alias("analysis_id"),
        analysis.alias("modelled_peril"),
        strip_ws("ExposureAttribute").alias("modelled_lob"),
        F.col("ModelCode").cast("long").alias("model_code"),
        F.col("YearID").cast("long").alias("year_id"),
        F.col("EventID").cast("long").alias("event_id"),
        F.col("GroundUpLoss").cast("double").alias("loss"),
    )
    return SC.assert_schema(out, SC.YLT_NORMALIZED, "stg_verisk_ylt")


def stage_risklink_ylt(raw: DataFrame) -> DataFrame:
    """Risklink rows carry only an analysis id; lob, peril and model code are typed nulls."""
    out = raw.select(
        F.lit("risklink").alias("vendor"),
        F.col("anlsid").cast("string").alias("analysis_id"),
        F.lit(None).cast("string").alias("modelled_peril"),
        F.lit(None).cast("string").alias("modelled_lob"),
        F.lit(None).cast("long").alias("model_code"),
        F.col("yearid").cast("long").alias("year_id"),
        F.col("eventid").cast("long").alias("event_id"),
        F.col("loss").cast("double").alias("loss"),
    )
    return SC.assert_schema(out, SC.YLT_NORMALIZED, "stg_risklink_ylt")


def normalize_ylt(verisk: DataFrame, risklink: DataFrame) -> DataFrame:
    """One YLT for both vendors (bag union, same schema)."""
    out = SC.conform(verisk, SC.YLT_NORMALIZED).unionByName(SC.conform(risklink, SC.YLT_NORMALIZED))
    return SC.assert_schema(out, SC.YLT_NORMALIZED, "int_ylt_normalized")


def stage_verisk_events(raw: DataFrame) -> DataFrame:
    out = raw.select(
        F.col("EventID").cast("long").alias("model_event_id"),
        F.col("ModelID").cast("long").alias("model_code"),
        F.col("Event").cast("long").alias("event_id"),
        F.col("Year").cast("long").alias("year_id"),
        F.col("Day").cast("long").alias("event_day"),
    )
    return SC.assert_schema(out, SC.VERISK_EVENTS, "stg_verisk_events")


def stage_risklink_events(raw: DataFrame) -> DataFrame:
    """Earliest occurrence date per (event, occurrence year, region peril) -> day of year.

    The date column must be a date or timestamp; strings are rejected.
    """
    dtype = raw.schema["ModelOccurrenceDate"].dataType.simpleString()
    if not (dtype == "date" or dtype.startswith("timestamp")):
        raise TypeError(
            f"stg_risklink_flood_events: ModelOccurrenceDate must be a date or timestamp, got {dtype}"
        )
    out = (
        raw.groupBy("ModelEventID", "ModelOccurrenceYear", "RegionPerilID")
        .agg(F.min("ModelOccurrenceDate").alias("model_occurrence_date"))
        .select(
            F.col("ModelEventID").cast("long").alias("event_id"),
            F.col("ModelOccurrenceYear").cast("long").alias("model_occurrence_year"),
            F.col("RegionPerilID").cast("long").alias("region_peril_id"),
            F.dayofyear("model_occurrence_date").cast("long").alias("risklink_event_day"),
        )
    )
    return SC.assert_schema(out, SC.RISKLINK_EVENTS, "stg_risklink_flood_events")


def stage_fx(fx_rates: DataFrame) -> DataFrame:
    """Rates into GBP only; the rate date stays text."""
    out = fx_rates.where(F.col("target_currency") == F.lit("GBP")).select(
        F.col("currency_code").cast("string").alias("currency"),
        F.col("target_currency").cast("string"),
        F.col("rate_date").cast("string").alias("fx_rate_date"),
        F.col("rate").cast("double").alias("fx_rate"),
    )
    return SC.assert_schema(out, SC.FX, "stg_gbp_fx_rates")


def stage_forecast_factors(forecast_factors: DataFrame) -> DataFrame:
    """``office`` is the ISO2 code; dates parse strictly as yyyy-MM-dd (bad text fails the job)."""
    text = F.col("forecast_date").cast("string")
    parsed = F.when(
        text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.to_date(text, "yyyy-MM-dd")
    ).otherwise(F.raise_error(F.concat(F.lit("stg_forecast_factors: bad forecast_date "), text)))
    out = forecast_factors.select(
        F.col("class").cast("string"),
        F.col("office_iso2").cast("string").alias("office"),
        F.when(text.isNull(), F.lit(None).cast("date")).otherwise(parsed).cast("date").alias("forecast_date"),
        F.col("factor").cast("double").alias("_forecast_factor_raw"),
    )
    return SC.assert_schema(out, SC.FORECAST_FACTORS, "stg_forecast_factors")


def blend_weights(blending_factors: DataFrame) -> DataFrame:
    out = blending_factors.select(
        F.col("RegionPerilID").cast("long").alias("region_peril_id"),
        F.col("SubRegionPerilID").cast("string").alias("blend_subregion_peril_id"),
        F.col("SubRegionPeril").cast("string").alias("sub_region_peril"),
        F.col("AIRBlend").cast("double").alias("verisk_weight"),
        F.col("RMSBlend").cast("double").alias("risklink_weight"),
    )
    return SC.assert_schema(out, SC.WEIGHTS, "int_ep_blending_weights")


def forecast_dates(staged_factors: DataFrame) -> DataFrame:
    """A3: distinct forecast dates."""
    out = staged_factors.select(F.col("forecast_date").cast("date")).distinct()
    return SC.assert_schema(out, SC.FORECAST_DATES, "int_forecast_dates")
