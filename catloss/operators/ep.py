"""EP-summary branch: enrich, select perils, align vendors, blend into uplift factors.

The seeds are joined as checked broadcasts. EP rows may be many (one per analysis, lob,
peril and point), and one rollup cell may hold most of them, so what is needed of a cell
comes from ``cell_losses``: one aggregation with map-side sums, after which a cell has a
row per peril and point however many EP rows it had. Those rows are dealt once by
(rollup_lob, rollup_peril); the winner's choice, the dialsup flags and the alignment of
the vendors all work within that one partitioning, without joins.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catloss import schemas as SC
from catloss.functions.exprs import any_null, clip_keep_null, ieee_div, sum0
from catloss.functions.joins import bounded_broadcast
from catloss.params import RunParams

SELECTION_KEYS = ("vendor", "rollup_lob", "rollup_peril")
DEFAULT_PRIORITY = 99


def enrich_ep(ep_summaries: DataFrame, lobs: DataFrame, perils: DataFrame) -> DataFrame:
    """Left-join lob and peril dimensions; missing priority -> 99."""
    lob_dims = lobs.select("modelled_lob", "rollup_lob", "cds_cat_class_name", "class", "office", "currency")
    peril_dims = perils.select(
        "modelled_peril", "rollup_peril", "region", "peril", "region_peril_id",
        "blend_subregion_peril_id", "base_model", "selection_priority", "is_dialsup", "is_euws",
    )
    out = (
        ep_summaries.join(bounded_broadcast(lob_dims), "modelled_lob", "left")
        .join(bounded_broadcast(peril_dims), "modelled_peril", "left")
        .withColumn(
            "selection_priority", F.coalesce(F.col("selection_priority"), F.lit(DEFAULT_PRIORITY))
        )
    )
    return SC.conform(out, SC.EP_ENRICHED)


def select_main_perils(enriched: DataFrame) -> DataFrame:
    """N3 + J2: per (vendor, rollup_lob, rollup_peril) keep the rows of the single
    modelled peril with the lowest priority (ties: alphabetically first peril).

    The winner is ``min(struct(priority, peril))`` - a partial aggregation, no sort -
    and the join back is a semi join (null keys never match).
    """
    winners = enriched.groupBy(*SELECTION_KEYS).agg(
        F.min(F.struct("selection_priority", "modelled_peril")).alias("_w")
    ).select(*SELECTION_KEYS, F.col("_w.modelled_peril").alias("modelled_peril"))
    out = enriched.join(
        bounded_broadcast(winners), [*SELECTION_KEYS, "modelled_peril"], "left_semi"
    )
    return SC.conform(out, SC.EP_ENRICHED)


def select_dialsup_perils(enriched: DataFrame) -> DataFrame:
    """Keep every modelled peril flagged ``is_dialsup = 1`` in its rollup cell."""
    flagged = enriched.where(F.col("is_dialsup") == 1).select(*SELECTION_KEYS, "modelled_peril").distinct()
    out = enriched.join(
        bounded_broadcast(flagged), [*SELECTION_KEYS, "modelled_peril"], "left_semi"
    )
    return SC.conform(out, SC.EP_ENRICHED)


CELL = ("rollup_lob", "rollup_peril")


def cell_losses(enriched: DataFrame) -> DataFrame:
    """A1: per vendor, modelled peril, its priority and the 7 keys, the summed loss, dealt by rollup cell."""
    keys = list(dict.fromkeys(["vendor", *SC.EP_JOIN_KEYS, "modelled_peril", "selection_priority"]))
    return enriched.groupBy(*keys).agg(sum0("loss").alias("loss")).repartition(*CELL)


def winning_losses(cells: DataFrame) -> DataFrame:
    """N3 + J2 on ``cell_losses``: the rows of each (vendor, rollup cell)'s winning peril; null keys win nothing."""
    cell = Window.partitionBy(*CELL, "vendor")
    best = F.min(F.struct("selection_priority", "modelled_peril")).over(cell)
    named = cells.withColumn("_best", best).where(F.col("modelled_peril") == F.col("_best.modelled_peril"))
    return named.where(~any_null(*SELECTION_KEYS)).drop("_best")


def vendor_joined(selected: DataFrame) -> DataFrame:
    """A1 + J6: per 7 keys, each vendor's summed loss side by side.

    One conditional aggregation replaces two aggregations and a full outer join; of
    ``winning_losses`` it needs no further exchange.
    A vendor without rows in a group gets null; a vendor whose rows are all null
    gets 0.0. Groups with a null key stay split per vendor, as the outer join
    never matches null keys.
    """
    keys = list(SC.EP_JOIN_KEYS)
    vendor = F.col("vendor")
    split = F.when(any_null(*keys), vendor)
    rows = selected.where(vendor.isin("risklink", "verisk")).withColumn("_split", split)
    agg = rows.groupBy(*keys, "_split").agg(
        F.count(F.when(vendor == "risklink", F.lit(1))).alias("_n_rl"),
        sum0(F.when(vendor == "risklink", F.col("loss"))).alias("_rl"),
        F.count(F.when(vendor == "verisk", F.lit(1))).alias("_n_vk"),
        sum0(F.when(vendor == "verisk", F.col("loss"))).alias("_vk"),
    )
    out = agg.select(
        *keys,
        F.when(F.col("_n_rl") > 0, F.col("_rl")).alias("risklink_loss"),
        F.when(F.col("_n_vk") > 0, F.col("_vk")).alias("verisk_loss"),
    )
    return SC.conform(out, SC.EP_VENDOR_JOINED)


def target_points(joined: DataFrame, params: RunParams) -> DataFrame:
    """keep configured (ep_type, return_period) points; an empty list keeps nothing."""
    predicate = functools.reduce(
        lambda acc, p: acc | ((F.col("ep_type") == p.ep_type) & (F.col("return_period") == p.return_period)),
        params.target_points,
        F.lit(False),
    )
    return SC.conform(joined.where(predicate), SC.EP_VENDOR_JOINED)


def blending_targets(points: DataFrame, weights: DataFrame, params: RunParams) -> DataFrame:
    """B1: blend both vendors' losses with the configured weights into an uplift on the base model.

    base = the base model's own loss (rows without it drop). With both vendor
    losses present the target is the weighted sum, otherwise the base loss.
    uplift = clip(target / base) with IEEE division and null-keeping clip.
    """
    losses = {v: F.col(f"{v}_loss") for v in ("risklink", "verisk")}
    own = F.when(F.col("base_model") == "risklink", losses["risklink"]).otherwise(losses["verisk"])
    both = losses["risklink"].isNotNull() & losses["verisk"].isNotNull()
    # a vendor's part of the target: its weighted loss, or all of the base loss where only the base model has one
    part = {
        v: F.when(both, x * F.col(f"{v}_weight")).otherwise(F.when(F.col("base_model") == v, own).otherwise(0.0))
        for v, x in losses.items()
    }
    target = F.when(both, part["risklink"] + part["verisk"]).otherwise(own)
    weighted = points.join(bounded_broadcast(weights), ["region_peril_id", "blend_subregion_peril_id"], "left")
    out = weighted.where(own.isNotNull()).withColumns({
        "base_model_loss": own,
        "target_loss": target,
        **{f"{v}_blended_contribution": x for v, x in part.items()},
        "uplift_factor_on_base_model": clip_keep_null(ieee_div(target, own), params.uplift_min, params.uplift_max),
    })
    return SC.conform(out, SC.EP_TARGETS)


def ep_branch(inputs, params: RunParams) -> dict[str, DataFrame]:
    """The whole EP branch from run inputs; returns every intermediate by name."""
    from catloss.operators.staging import blend_weights

    enriched = enrich_ep(inputs.ep_summaries, inputs.seed("lobs"), inputs.seed("perils"))
    joined = vendor_joined(winning_losses(cell_losses(enriched)))
    points = target_points(joined, params)
    weights = blend_weights(inputs.seed("blending_factors"))
    return {
        "ep_enriched": enriched,
        "ep_selected_main": select_main_perils(enriched),
        "ep_selected_dialsup": select_dialsup_perils(enriched),
        "ep_vendor_joined": joined,
        "ep_target_points": points,
        "blend_weights": weights,
        "ep_blending_targets": blending_targets(points, weights, params),
    }
