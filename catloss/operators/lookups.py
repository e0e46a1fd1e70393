"""Lookups attached to ranked YLT rows as arrays, so fan-outs can be replayed exactly.

A left join against a lookup with duplicate keys multiplies rows. The metric
streams need that fan-out only for some stages, so each lookup is grouped by its
key into an array of matches and exploded exactly where the reference joins.
Seed-sized lookups are broadcast after a size check; the event catalogue is
grouped on its join keys, so its side of the join needs no further shuffle when
it is too large to broadcast.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catloss.functions.joins import bounded_broadcast, is_bounded

CAT_KEYS = ["event_id", "year_id", "model_code"]
TARGET_KEYS = ["rollup_lob", "rollup_peril", "region_peril_id", "blend_subregion_peril_id", "rp_bucket", "base_model"]

CAT_ELEMENT = T.StructType([
    T.StructField("model_event_id", T.LongType()),
    T.StructField("event_day", T.LongType()),
    T.StructField("factors", T.ArrayType(T.DoubleType())),
])


def no_catalogue_match() -> F.Column:
    """Array with one all-null catalogue element (what a non-matching left join yields)."""
    return F.array(F.lit(None).cast(CAT_ELEMENT))


def catalogue_lookup(verisk_events: DataFrame, euws_factors: DataFrame) -> DataFrame:
    """(event_id, year_id, model_code) -> array of (model_event_id, event_day, [euws factors])."""
    factors = euws_factors.groupBy("model_event_id").agg(
        F.collect_list(F.struct(F.col("factor").cast("double").alias("v"))).alias("factors")
    )
    cat = verisk_events.join(factors, "model_event_id", "left").select(
        *CAT_KEYS, F.struct("model_event_id", "event_day", F.col("factors.v").alias("factors")).cast(CAT_ELEMENT).alias("_c")
    )
    return cat.groupBy(*CAT_KEYS).agg(F.collect_list("_c").alias("_cat"))


def attach_catalogue(ranked: DataFrame, verisk_events: DataFrame, euws_factors: DataFrame) -> DataFrame:
    """J12 (+ J13 factors) as one array column ``_cat``; null when the event is not listed.

    Broadcast when the raw catalogue and the factors are within the broadcast bound;
    otherwise a shuffle join whose catalogue side is already partitioned by the join keys.
    """
    cat = catalogue_lookup(verisk_events, euws_factors)
    # The grouped catalogue has at most as many rows as the raw one, its arrays as many factors.
    if is_bounded(verisk_events) and is_bounded(euws_factors):
        cat = F.broadcast(cat)
    return ranked.join(cat, CAT_KEYS, "left")


def written_catalogue(verisk_events: DataFrame, euws_factors: DataFrame, write: Callable[[DataFrame, str], DataFrame]) -> tuple[DataFrame, bool]:
    """The catalogue lookup as a written table, and whether it is within the broadcast bound.

    Rows whose join keys hold a null are left out: they match nothing.
    """
    listed = verisk_events.dropna(subset=CAT_KEYS)
    known = euws_factors.where(F.col("model_event_id").isNotNull())
    cat = write(catalogue_lookup(listed, known), "catalogue")
    return cat, is_bounded(cat)


def join_catalogue(rows: DataFrame, cat: DataFrame) -> DataFrame:
    """J12 by a shuffle, of the rows that can match only.

    Rows with a null key (all risklink rows: they have no model code) and, where the Bloom
    filter of Spark applies, rows of events that the catalogue doesn't list stay where they are.
    """
    can = F.lit(True)
    for k in CAT_KEYS:
        can = can & F.col(k).isNotNull()
    none = F.lit(None).cast(cat.schema["_cat"].dataType)
    return rows.where(can).join(cat, CAT_KEYS, "left").unionByName(rows.where(~can).withColumn("_cat", none))


def targets_lookup(targets: DataFrame) -> DataFrame:
    """J8 lookup: 6 keys -> array of (diagnostics, uplift)."""
    t = targets.select(
        "rollup_lob", "rollup_peril", "region_peril_id", "blend_subregion_peril_id", "base_model",
        F.col("return_period").alias("rp_bucket"),
        F.struct(
            "risklink_blended_contribution", "verisk_blended_contribution", "uplift_factor_on_base_model"
        ).alias("_t"),
    )
    return bounded_broadcast(t.groupBy(*TARGET_KEYS).agg(F.collect_list("_t").alias("_targets")))


def fx_lookup(fx: DataFrame) -> DataFrame:
    """J9 lookup: currency -> array of (target_currency, fx_rate_date, fx_rate)."""
    g = fx.groupBy("currency").agg(
        F.collect_list(F.struct("target_currency", "fx_rate_date", "fx_rate")).alias("_fx")
    )
    return bounded_broadcast(g)


def dates_lookup(dates: DataFrame) -> DataFrame:
    """All distinct forecast dates as one single-row array (cross join partner)."""
    return bounded_broadcast(dates.agg(F.collect_list(F.struct("forecast_date")).alias("_d")).select(F.col("_d.forecast_date").alias("_dates")))


def factors_lookup(factors: DataFrame, date_col: str = "_d") -> DataFrame:
    """J11 lookup: (class, office, forecast_date) -> array of raw factors."""
    g = factors.groupBy("class", "office", F.col("forecast_date").alias(date_col)).agg(
        F.collect_list(F.struct("_forecast_factor_raw")).alias("_ff")
    ).withColumn("_ff", F.col("_ff._forecast_factor_raw"))
    return bounded_broadcast(g)


def overrides_lookup(overrides: DataFrame) -> DataFrame:
    """J14 lookup: rollup_lob -> array of (max_rank, factor)."""
    g = overrides.groupBy("rollup_lob").agg(
        F.collect_list(F.struct(F.col("max_rank").cast("long").alias("max_rank"),
                                F.col("factor").cast("double").alias("factor"))).alias("_ovr")
    )
    return bounded_broadcast(g)


def single_lookups(targets: DataFrame, fx: DataFrame, factors: DataFrame, overrides: DataFrame, cat: DataFrame) -> frozenset[str]:
    """Which lookups hold at most one match for every key, from one job over them."""
    several = {
        "targets": targets.groupBy("rollup_lob", "rollup_peril", "region_peril_id", "blend_subregion_peril_id", "return_period", "base_model").count(),
        "fx": fx.groupBy("currency").count(), "factors": factors.groupBy("class", "office", "forecast_date").count(),
        "overrides": overrides.groupBy("rollup_lob").count(), "catalogue": cat.select(F.size("_cat").alias("count")),
        "event_factors": cat.select(F.explode(F.col("_cat.factors")).alias("_fs")).select(F.size("_fs").alias("count")),
    }
    found = [df.where(F.col("count") > 1).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, df in several.items()]
    return frozenset(r["name"] for r in functools.reduce(DataFrame.unionByName, found).collect() if not r["n"])


def first_or_none(*positions: str) -> F.Column:
    """True on the single row where every exploded position is null or 0."""
    cond = F.lit(True)
    for p in positions:
        cond = cond & (F.col(p).isNull() | (F.col(p) == 0))
    return cond
