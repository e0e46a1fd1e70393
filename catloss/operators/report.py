"""EP report over the final losses: AAL, annual AEP / OEP at target ranks.

The final losses are aggregated once per (portfolio key, simulated year) - a
partial (map-side) aggregation, so a hot key is reduced before the shuffle. Of all
annual losses of a key only those at a few ranks are reported, so nothing is ranked:
a histogram of value ranges, counted map-side, says in which range each rank lies, and a
second pass counts the distinct values of those ranges alone. No sort and no window
sees a key's years.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catloss import schemas as SC
from catloss.functions.exprs import ieee_div, sum0
from catloss.functions.joins import bounded_broadcast
from catloss.operators.dialsup import FINAL_DIALSUP_METRIC
from catloss.operators.main_stream import FINAL_MAIN_METRIC
from catloss.params import RunParams

REPORT_KEYS = ["forecast_date", "metric", "base_model", "rollup_lob", "rollup_peril"]
LOSS_COLUMNS = ["forecast_date", "base_model", "rollup_lob", "rollup_peril", "year_id", "metric", "loss"]
REPORT_ORDER = ["forecast_date", "metric", "ep_type", "return_period", "base_model", "rollup_lob", "rollup_peril"]


def n_simulations(params: RunParams) -> F.Column:
    """Simulation count per base model; an unknown base model fails the job."""
    expr = F.raise_error(F.concat(F.lit("ep_report: no simulation count for base model "),
                                  F.coalesce(F.col("base_model"), F.lit("<null>"))))
    for model, n in params.simulation_counts.items():
        expr = F.when(F.col("base_model") == model, F.lit(int(n))).otherwise(expr)
    return expr.cast("long")


def report_losses(main_long_df: DataFrame, dialsup_long_df: DataFrame, params: RunParams) -> DataFrame:
    """Final losses of both streams (7 columns) with the simulation count."""
    main = main_long_df.where(F.col("metric") == FINAL_MAIN_METRIC).select(*LOSS_COLUMNS)
    dial = dialsup_long_df.where(F.col("metric") == FINAL_DIALSUP_METRIC).select(*LOSS_COLUMNS)
    return main.unionByName(dial).withColumn("n_simulations", n_simulations(params))


def annual(losses: DataFrame) -> DataFrame:
    """One row per key and simulated year: ``aep`` sums the year's losses, ``oep`` takes
    the largest event. This is the only aggregation over the (large) loss rows; map-side
    partial aggregation shrinks it before the shuffle."""
    return losses.groupBy(*REPORT_KEYS, "year_id").agg(
        sum0("loss").alias("aep"), F.max("loss").alias("oep"), F.max("n_simulations").alias("n_simulations")
    )


def aal(annual_df: DataFrame) -> DataFrame:
    """Total loss / simulations per key; return period, rank and rp are 0."""
    out = annual_df.groupBy(*REPORT_KEYS).agg(
        sum0("aep").alias("_total"), F.max("n_simulations").alias("_n")
    ).select(
        *REPORT_KEYS,
        F.lit("AAL").alias("ep_type"),
        F.lit(0).cast("long").alias("return_period"),
        F.lit(0).cast("long").alias("rank"),
        F.lit(0.0).alias("rp"),
        ieee_div("_total", "_n").alias("loss"),
    )
    return SC.conform(out, SC.EP_REPORT)


def target_rank_rows(params: RunParams) -> list[tuple[str, int, int]]:
    """rank = round(n / return period) with Python's round-half-even, per base model."""
    return [
        (model, int(rp), int(round(n / rp)))
        for model, n in params.simulation_counts.items()
        for rp in params.return_periods
    ]


def _targets_of(base_model: F.Column, params: RunParams) -> F.Column:
    """Array of (return_period, rank) targets for the row's base model (empty if unknown)."""
    by_model: dict[str, list[tuple[int, int]]] = {}
    for model, rp, rank in target_rank_rows(params):
        by_model.setdefault(model, []).append((rp, rank))
    elem = "struct<return_period:bigint,rank:bigint>"
    expr = F.array().cast(f"array<{elem}>")
    for model, pairs in by_model.items():
        arr = F.array(*[F.struct(F.lit(rp).cast("long").alias("return_period"), F.lit(r).cast("long").alias("rank"))
                        for rp, r in pairs]).cast(f"array<{elem}>")
        expr = F.when(base_model == model, arr).otherwise(expr)
    return expr


RANGES = 64  # value ranges per factor of e


def value_range(x: F.Column) -> F.Column:
    """Number of the range that a loss lies in; greater losses have greater or equal numbers, null the least."""
    far = 800 * RANGES  # beyond the logarithm of any double
    magnitude = F.floor(F.log(F.abs(x)) * RANGES) + far
    return (
        F.when(x.isNull(), -3 * far).when(F.isnan(x), 3 * far).when(x == 0, 0)
        .when(F.abs(x) == float("inf"), F.signum(x) * 2 * far).otherwise(F.signum(x) * (magnitude + 1)).cast("long")
    )


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> F.Column:
    return functools.reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_{k}"]) for k in keys])


def select_ranks(values: DataFrame, keys: list[str], targets: F.Column) -> DataFrame:
    """N4 + J18: rows (keys, return_period, rank, loss) of the losses at the target ranks of each key, largest first.

    ``values`` has the keys and ``loss``; ``targets`` is an array of (return_period, rank) made
    of key columns. Ranks beyond a key's values give no row. Two passes over ``values``: counts
    by value range, then counts of the distinct values in the ranges that hold a target.
    """
    cell = [*keys, "_range"]
    placed = values.select(*keys, "loss", value_range(F.col("loss")).alias("_range"))
    upto = F.sum("_n").over(Window.partitionBy(*keys).orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, 0))
    ranges = placed.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n")).select(*cell, "_n", upto.alias("_upto"))
    here = F.filter(targets, lambda t: (t["rank"] > F.col("_upto") - F.col("_n")) & (t["rank"] <= F.col("_upto")))
    inside = F.transform(here, lambda t: F.struct(t["return_period"].alias("return_period"), t["rank"].alias("rank"), (t["rank"] - F.col("_upto") + F.col("_n")).alias("place")))
    wanted = ranges.select(*[F.col(c).alias(f"_{c}") for c in cell], inside.alias("_wanted")).where(F.size("_wanted") > 0)
    # a row per key and target at most
    found = placed.join(bounded_broadcast(wanted), _same(placed, wanted, cell)).groupBy(*cell, "loss", "_wanted").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*cell).orderBy(F.col("loss").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0))
    hits = F.filter("_wanted", lambda t: (t["place"] > F.col("_upto") - F.col("_n")) & (t["place"] <= F.col("_upto")))
    return found.select("*", upto.alias("_upto")).select(*keys, "loss", F.inline(hits)).select(*keys, "return_period", "rank", "loss")


def ep_report(
    main_long_df: DataFrame, dialsup_long_df: DataFrame, params: RunParams, order: bool = True,
    write: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """AAL, AEP and OEP rows in report order.

    The annual losses of each key (``annual``; written once where ``write`` is given) give its
    total, its years and, by ``select_ranks``, the losses at its target ranks. Target ranks
    that a key doesn't reach get 0.0 - the same rows as "every key x every target rank,
    left join".
    """
    yearly = annual(report_losses(main_long_df, dialsup_long_df, params))
    yearly = write(yearly, "annual") if write else yearly
    n, targets = F.col("n_simulations"), _targets_of(F.col("base_model"), params)
    stacked = yearly.select(*REPORT_KEYS, "n_simulations", F.inline(F.array(
        F.struct(F.lit("AEP").alias("ep_type"), F.col("aep").alias("loss")), F.struct(F.lit("OEP").alias("ep_type"), F.col("oep").alias("loss")),
    )))
    hits = select_ranks(stacked, [*REPORT_KEYS, "n_simulations", "ep_type"], targets)
    keyed = yearly.groupBy(*REPORT_KEYS, "n_simulations").agg(sum0("aep").alias("_total"), F.count(F.lit(1)).alias("_years"))

    def out(ep_type: F.Column, period: F.Column, rank: F.Column, loss: F.Column) -> F.Column:
        return F.struct(ep_type.alias("ep_type"), period.cast("long").alias("return_period"), rank.cast("long").alias("rank"), loss.cast("double").alias("loss"))

    beyond = F.filter(targets, lambda t: (t["rank"] < 1) | (t["rank"] > F.col("_years")))
    zeros = [F.transform(beyond, functools.partial(lambda kind, t: out(F.lit(kind), t["return_period"], t["rank"], F.lit(0.0)), kind)) for kind in ("AEP", "OEP")]
    aal_row = F.array(out(F.lit("AAL"), F.lit(0), F.lit(0), ieee_div("_total", "n_simulations")))
    report = keyed.select(*REPORT_KEYS, "n_simulations", F.inline(F.concat(aal_row, *zeros))).unionByName(
        hits.withColumn("loss", F.coalesce("loss", F.lit(0.0))))
    report = report.withColumn("rp", F.when(F.col("ep_type") == "AAL", F.lit(0.0)).otherwise(ieee_div(n, F.col("rank"))))
    report = SC.conform(report, SC.EP_REPORT)
    return report.orderBy(*REPORT_ORDER) if order else report
