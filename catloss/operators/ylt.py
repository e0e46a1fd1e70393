"""YLT branch: enrich with EP dimensions, select base-model rows, rank events.

The YLT is the only large input. Lookups joined to it are seed-sized and
broadcast after a size check. Ranking is the one wide operation; see
``rank_events`` for the two strategies.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catloss import schemas as SC
from catloss.functions.exprs import rp_bucket, vendor_years
from catloss.functions.joins import bounded_broadcast
from catloss.params import RunParams
from catloss.session import ensure_checkpoint_dir

# Ranking cell and order (loss descending, then tie-break keys ascending).
RANK_CELL = ("vendor", "modelled_lob", "rollup_peril")
RANK_TIE_BREAK = ("year_id", "event_id", "analysis_id", "model_code")


def enrich_ylt(normalized: DataFrame, ep_selected: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Attach the 12 EP dimension columns to YLT rows.

    verisk rows match on (vendor, modelled_lob, modelled_peril); risklink rows,
    which have no lob or peril, match on (vendor, analysis_id) - one analysis may
    map to several lob/peril rows, which fans out on purpose. ``carry`` names extra
    lookup columns (e.g. a stream tag) that pass through to the output.
    """
    keys = list(SC.ENRICH_KEY_COLUMNS)
    carry = list(carry)
    out_cols = [f.name for f in SC.YLT_ENRICHED.fields] + carry

    verisk_keys = (
        ep_selected.where(F.col("vendor") == "verisk")
        .select("vendor", "modelled_lob", "modelled_peril", *keys, *carry)
        .distinct()
    )
    verisk = (
        normalized.where(F.col("vendor") == "verisk")
        .join(bounded_broadcast(verisk_keys), ["vendor", "modelled_lob", "modelled_peril"], "inner")
        .select(*out_cols)
    )
    risklink_keys = (
        ep_selected.where(F.col("vendor") == "risklink")
        .select("vendor", "analysis_id", "modelled_lob", "modelled_peril", *keys, *carry)
        .distinct()
    )
    risklink = (
        normalized.where(F.col("vendor") == "risklink")
        .drop("modelled_lob", "modelled_peril")
        .join(bounded_broadcast(risklink_keys), ["vendor", "analysis_id"], "inner")
        .select(*out_cols)
    )
    out = verisk.unionByName(risklink)
    return out.select(*[out[f.name].cast(f.dataType) for f in SC.YLT_ENRICHED.fields], *carry)


def select_base_rows(enriched: DataFrame, params: RunParams, carry: Sequence[str] = ()) -> DataFrame:
    """rows of the base model only, loss >= threshold / 5, tagged ``original``.

    The loss predicate reaches the parquet scan; null base model or loss drops.
    """
    out = enriched.where(
        (F.col("vendor") == F.col("base_model")) & (F.col("loss") >= F.lit(params.prefilter_threshold))
    ).withColumn("metric", F.lit("original"))
    return out.select(*SC.names(SC.YLT_BASE), *carry)


def _order_exprs() -> list[Column]:
    return [F.col("loss").desc_nulls_first()] + [F.col(c).asc_nulls_first() for c in RANK_TIE_BREAK]


def rank_events(
    ylt: DataFrame,
    params: RunParams,
    cell: Sequence[str] = RANK_CELL,
    strategy: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """N1 + N2: rank events by loss within each cell; return period and bucket.

    ``rnk`` is the 1-based position in (loss desc, year_id, event_id, analysis_id,
    model_code asc, nulls first) within the cell (losses are non-null after F2).
    ``rp = simulated years of the vendor / rnk``; ``rp_bucket`` is the largest
    configured OEP return period not above ``rp`` (else 0).

    strategy ``window``: one window partition per cell - all rows of a cell sort
    in one task. Fine for small inputs.
    strategy ``range``: range-partition on (cell, order keys) so that a cell spans
    many tasks, sort inside each partition, materialise once (reliable checkpoint,
    so partition ids and positions are stable under retries), count rows per
    (partition, cell), turn the counts into offsets with a prefix sum over that
    tiny table, and add each row's position inside its partition. No task ever
    holds a whole cell, so a cell with a third of all rows still spreads out.
    """
    strategy = strategy or params.rank_strategy
    cell = list(cell)
    extra = [c for c in ylt.columns if c not in SC.names(SC.YLT_BASE)]
    if strategy == "window":
        w = Window.partitionBy(*cell).orderBy(*_order_exprs())
        ranked = ylt.withColumn("rnk", F.row_number().over(w).cast("long"))
    elif strategy == "range":
        ranked = _rank_by_range(ylt, cell, partitions or params.rank_partitions)
    else:
        raise ValueError(f"unknown rank strategy {strategy!r}")
    ranked = ranked.withColumn("rp", vendor_years("vendor", params.vendor_years) / F.col("rnk")).withColumn(
        "rp_bucket", rp_bucket("rp", params.oep_bucket_points)
    )
    return ranked.select(*[F.col(f.name).cast(f.dataType) for f in SC.YLT_RANKED.fields], *extra)


def _rank_by_range(ylt: DataFrame, cell: list[str], partitions: int | None) -> DataFrame:
    spark = ylt.sparkSession
    ensure_checkpoint_dir(spark)
    placed = _placed(ylt, cell, partitions).checkpoint(eager=True)
    return _positions(placed, _offsets(placed, cell), cell).select(*[F.col(c) for c in ylt.columns], "rnk")


def _placed(ylt: DataFrame, cell: list[str], partitions: int | None) -> DataFrame:
    """Rows range-partitioned and sorted in rank order, with partition and position."""
    n = partitions or int(ylt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A unique row id as the last sort key lets the range partitioner split even
    # rows that tie on every rank key.
    keyed = ylt.withColumn("_rid", F.monotonically_increasing_id())
    sort_keys = [F.col(c).asc_nulls_first() for c in cell] + _order_exprs() + [F.col("_rid")]
    return (
        keyed.repartitionByRange(n, *sort_keys)
        .sortWithinPartitions(*sort_keys)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id())
        .drop("_rid")
    )


def _offsets(placed: DataFrame, cell: list[str]) -> DataFrame:
    """Per (partition, cell): what to add to a position for its rank. At most partitions + cells rows."""
    counts = placed.groupBy("_pid", *cell).agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    before = Window.partitionBy(*cell).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    add = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1
    return counts.select(F.col("_pid").alias("_o_pid"), *[F.col(c).alias(f"_o_{c}") for c in cell], add.alias("_add"))


def _positions(placed: DataFrame, offsets: DataFrame, cell: list[str]) -> DataFrame:
    cond = F.col("_pid") == F.col("_o_pid")
    for c in cell:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    joined = placed.join(F.broadcast(offsets), cond, "inner")
    return joined.withColumn("rnk", (F.col("_pos") + F.col("_add")).cast("long")).drop(*offsets.columns, "_pid", "_pos")


# --- ranked narrow rows -------------------------------------------------------------
# A YLT row's dimensions all come from one row of the EP selection, so ranking needs only
# that row's id beside the event and its loss; the dimensions are joined to ranked rows.
NARROW = ("_stream", "_cell", "_dim", "analysis_id", "model_code", "year_id", "event_id", "loss")


def dimension_rows(selected: Mapping[str, DataFrame], write: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """A12 for all streams: the distinct EP dimension rows of base models, with ids of row and ranking cell.

    Written once, so that an id means the same row wherever it is read.
    """
    parts = [
        ep.where(F.col("vendor") == F.col("base_model")).select(
            F.lit(stream).alias("_stream"), "vendor", F.when(F.col("vendor") == "risklink", F.col("analysis_id")).alias("_analysis"),
            "modelled_lob", "modelled_peril", *SC.ENRICH_KEY_COLUMNS).distinct()
        for stream, ep in selected.items()
    ]
    rows = functools.reduce(DataFrame.unionByName, parts).withColumn("_dim", F.monotonically_increasing_id())
    cell = Window.partitionBy("_stream", *RANK_CELL)
    return write(rows.withColumn("_cell", F.min("_dim").over(cell)), "dimensions")


def narrow_rows(normalized: DataFrame, dims: DataFrame, params: RunParams) -> DataFrame:
    """J4 / J5 / U2 / F2 with ids in place of dimensions: one row per YLT row, stream and matching dimension row."""
    ids = ["_stream", "_cell", "_dim"]
    rows = normalized.where(F.col("loss") >= F.lit(params.prefilter_threshold))
    verisk = rows.where(F.col("vendor") == "verisk").join(
        bounded_broadcast(dims.where(F.col("vendor") == "verisk").select("vendor", "modelled_lob", "modelled_peril", *ids)), ["vendor", "modelled_lob", "modelled_peril"])
    risklink = rows.where(F.col("vendor") == "risklink").join(
        bounded_broadcast(dims.where(F.col("vendor") == "risklink").select("vendor", F.col("_analysis").alias("analysis_id"), *ids)), ["vendor", "analysis_id"])
    return verisk.select(*NARROW).unionByName(risklink.select(*NARROW))


def rank_narrow(narrow: DataFrame, params: RunParams, write: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """N1 on narrow rows, written once as Parquet by stream: columns NARROW and ``rnk``.

    ``range``: positions and offsets are written, and a reader adds them (see ``rank_events``);
    ``window``: the ranked rows themselves are.
    """
    if params.rank_strategy == "window":
        w = Window.partitionBy("_cell").orderBy(*_order_exprs())
        return write(narrow.withColumn("rnk", F.row_number().over(w).cast("long")), "ranked")
    # Written first, as the bounds of the ranges come from a pass of their own: it and the
    # sort then read these few columns and not the YLT.
    narrow = write(narrow, "narrow")
    # the stream leads, so that every partition's files hold few streams
    placed = write(_placed(narrow, ["_stream", "_cell"], params.rank_partitions), "ranked")
    return _positions(placed, write(_offsets(placed, ["_cell"]), "offsets"), ["_cell"])


def widen(ranked: DataFrame, dims: DataFrame, params: RunParams, carry: Sequence[str] = ()) -> DataFrame:
    """Ranked narrow rows with their dimensions, return period and bucket (N2): YLT_RANKED, ``_stream`` and ``carry``."""
    wide = ranked.join(bounded_broadcast(dims.drop("_stream", "_cell", "_analysis")), "_dim").withColumn("metric", F.lit("original"))
    wide = wide.withColumn("rp", vendor_years("vendor", params.vendor_years) / F.col("rnk")).withColumn("rp_bucket", rp_bucket("rp", params.oep_bucket_points))
    return wide.select(*[F.col(f.name).cast(f.dataType) for f in SC.YLT_RANKED.fields], "_stream", *carry)
