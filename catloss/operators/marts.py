"""Published marts: thresholded long tables, fanout rows, event validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catloss import schemas as SC
from catloss.functions.joins import is_bounded
from catloss.operators.dialsup import FINAL_DIALSUP_METRIC
from catloss.operators.main_stream import FINAL_MAIN_METRIC


def _threshold(threshold: float) -> F.Column:
    """Loss >= threshold; a threshold <= 0 only drops null losses."""
    return F.col("loss").isNotNull() if threshold <= 0 else F.col("loss") >= F.lit(float(threshold))


def main_long(stream: DataFrame, threshold: float) -> DataFrame:
    """Only final-metric rows are thresholded; audit stages pass through."""
    final = F.col("metric") == FINAL_MAIN_METRIC
    out = stream.where(~final | _threshold(threshold)).withColumn(
        "output_use", F.when(final, F.lit("cds_main")).otherwise(F.lit("intermediate_audit"))
    )
    return SC.conform(out, SC.MAIN_LONG)


def dialsup_long(stream: DataFrame, threshold: float) -> DataFrame:
    """Only the final dialsup metric above the threshold is published."""
    out = stream.where((F.col("metric") == FINAL_DIALSUP_METRIC) & _threshold(threshold)).withColumn(
        "output_use", F.lit("cds_dialsup")
    )
    return SC.conform(out, SC.DIALSUP_LONG)


def with_risklink_event_days(ylt: DataFrame, risklink_events: DataFrame,
                             catalogue_small: bool | None = None) -> DataFrame:
    """Risklink rows need their occurrence in the flood catalogue (else dropped);
    other base models are kept with null occurrence columns; null base model drops.

    The staged catalogue is unique per (event, occurrence year, region peril), so the
    join never multiplies rows. It is broadcast when ``catalogue_small`` (callers pass
    the size check of the *raw* catalogue, an upper bound that needs no aggregation);
    when unknown, the staged catalogue itself is checked. Otherwise the same join is
    shuffled on the event keys, which spread the other base models' rows too.
    """
    cat = risklink_events.select(
        F.col("event_id").alias("_ev"), F.col("model_occurrence_year"), F.col("region_peril_id").alias("_rp"),
        "risklink_event_day",
    )
    if catalogue_small is None:
        catalogue_small = is_bounded(cat)
    is_rl = F.col("base_model") == "risklink"
    # One pass: a left join that only risklink rows can match, then keep other base
    # models and matched risklink rows (null base model drops).
    x = ylt.join(
        F.broadcast(cat) if catalogue_small else cat,
        (ylt["event_id"] == cat["_ev"]) & (ylt["year_id"] == cat["model_occurrence_year"])
        & (ylt["region_peril_id"] == cat["_rp"]) & is_rl,
        "left",
    )
    return x.where(~is_rl | F.col("_ev").isNotNull()).drop("_ev", "_rp")


def fanout(ylt: DataFrame, risklink_events: DataFrame, catalogue_small: bool | None = None) -> DataFrame:
    """The 11-column fanout layout."""
    x = with_risklink_event_days(ylt, risklink_events, catalogue_small)
    rl = F.col("base_model") == "risklink"
    out = x.select(
        "forecast_date",
        "base_model",
        "metric",
        F.when(rl, F.col("event_id")).otherwise(F.col("model_event_id")).cast("long").alias("ModelEventID"),
        F.col("year_id").cast("long").alias("ModelYear"),
        F.col("target_currency").alias("CurrencyCode"),
        F.lit(0).cast("long").alias("ModelYOA"),
        F.col("loss").cast("double").alias("ModelGrossLoss"),
        F.lit(0).cast("long").alias("ModelInwardsReinstatement"),
        F.when(rl, F.col("risklink_event_day")).otherwise(F.col("event_day")).cast("long").alias("ModelEventDay"),
        F.col("cds_cat_class_name").alias("LossClassName"),
    )
    return SC.conform(out, SC.FANOUT)


def main_fanout(main_long_df: DataFrame, risklink_events: DataFrame,
                catalogue_small: bool | None = None) -> DataFrame:
    """F6 + B11: final main metric rows only."""
    return fanout(main_long_df.where(F.col("metric") == FINAL_MAIN_METRIC), risklink_events, catalogue_small)


def dialsup_fanout(dialsup_long_df: DataFrame, risklink_events: DataFrame,
                   catalogue_small: bool | None = None) -> DataFrame:
    return fanout(dialsup_long_df, risklink_events, catalogue_small)


def event_validation(main_fan: DataFrame, dialsup_fan: DataFrame) -> DataFrame:
    """A4: rows and missing event ids / days per (base_model, metric, forecast_date)."""

    def report(f: DataFrame) -> DataFrame:
        return f.groupBy("base_model", "metric", "forecast_date").agg(
            F.count(F.lit(1)).cast("long").alias("row_count"),
            F.count_if(F.col("ModelEventID").isNull()).cast("long").alias("missing_model_event_id"),
            F.count_if(F.col("ModelEventDay").isNull()).cast("long").alias("missing_model_event_day"),
        )

    out = report(main_fan).unionByName(report(dialsup_fan))
    return SC.conform(out, SC.EVENT_VALIDATION)
