"""Mixing sources to target weights by weighted fair queueing.

Sources, ordered by code point with null last, get ``WEIGHTS`` in turn and share a budget
of 100% of all sizes; no source's target exceeds ``EPOCHS`` times its size, the excess is
shared again by weight. Every document gets a virtual finish time: the words of its source
up to and including it, in shuffled order, divided by the source's target. Sources with a
target above their size queue again, shuffled anew, for another epoch. All queue entries
are sorted by finish time and the mix takes them until the budget is used up, so each
source's share follows its target to within about one document.

Both cumulative sums run over range partitions (``common.running_total``), so a source
that holds most rows is spread like any other.

Defined cases: null text has size 0; a null source is a source of its own; rows without
words are taken 0 times; repeated rows queue separately; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catloss.llm.common import WORD, materialize, maybe_broadcast, null_safe, packed, row_hash, running_total, text_or_empty

WEIGHTS = (5, 2, 1)
EPOCHS = 3
SEED = 17


def source_targets(sizes: DataFrame) -> DataFrame:
    """Rows (source, rank, source_size, target) from rows (source, size)."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("none", F.col("source").isNull()).withColumn("one", F.lit(1).cast("long"))
    ranked = running_total(per, ["none", "source"], {"one": "rank"})
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), ((F.col("rank") - 1) % len(WEIGHTS) + 1).cast("int")).cast("long")
    capped = ranked.select("source", "rank", "source_size", weight.alias("weight"), (EPOCHS * F.col("source_size")).alias("cap"))
    filled = materialize(running_total(capped.withColumn("level", F.col("cap") / F.col("weight")), ["level", "rank"], {"cap": "caps", "weight": "weights"}), "sources")
    # sources fill up in the order of level; the first that doesn't fix the others' common level
    whole = filled.agg(F.sum("source_size").alias("budget"), F.sum("weight").alias("all_weights"))
    open_level = (F.col("budget") - F.col("caps") + F.col("cap")) / (F.col("all_weights") - F.col("weights") + F.col("weight"))
    common = (
        filled.crossJoin(F.broadcast(whole)).withColumn("open", open_level)  # one row
        .agg(F.min_by("open", F.when(F.col("open") <= F.col("level"), F.struct("level", "rank"))).alias("common"))
    )
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.coalesce(F.col("common"), F.lit(float("inf"))))
    return filled.crossJoin(F.broadcast(common)).select("source", "rank", "source_size", target.alias("target"))


def queue(docs: DataFrame, keys: list[str]) -> DataFrame:
    """One row per document: keys, size, source, source_size, target, taken (words that the mix takes)."""
    base = docs.select(*keys, "source", F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"))
    base = materialize(base.withColumn("row", F.monotonically_increasing_id()), "sizes")
    sources = source_targets(base.select("source", "size"))
    # as many epochs as the target can reach
    share = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")) + 1).otherwise(1)
    sources = sources.withColumn("epochs", F.least(F.lit(EPOCHS), share).cast("long"))
    sources = sources.withColumn("queued", F.col("epochs") * F.col("source_size"))
    sources = materialize(running_total(sources, ["rank"], {"queued": "until"}), "sources")
    entries = null_safe(base, maybe_broadcast(sources), ["source"])
    entries = entries.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("epochs") - 1)))
    entries = entries.withColumn("at", F.xxhash64(F.lit(SEED), "epoch", *keys, "size"))
    entries = running_total(entries, ["rank", "epoch", "at", "row"], {"size": "upto"})
    used = F.col("upto") - F.col("until") + F.col("queued")
    entries = entries.withColumn("finish", F.when(F.col("target") > 0, used / F.col("target")).otherwise(0.0))
    order = ["finish", "rank", "epoch", "at", "row"]
    mixed = running_total(entries.select(*keys, "source", "size", "source_size", "target", *order), order, {"size": "total"})
    budget = F.broadcast(sources.agg(F.sum("source_size").alias("budget")))  # one row
    return (
        mixed.crossJoin(budget).groupBy("row", *keys, "source", "size", "source_size", "target")
        .agg(F.sum(F.when(F.col("total") <= F.col("budget"), F.col("size")).otherwise(0)).alias("taken"))
        .drop("row")
    )


def mix_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: every document as often as the queue takes it, with its columns."""
    hashes = row_hash(docs)
    taken = queue(docs.select(*hashes, "source", "text"), ["_h1", "_h2"])
    times = taken.where("taken > 0").groupBy("_h1", "_h2").agg(F.sum(F.col("taken") / F.col("size")).cast("int").alias("times"), F.count("*").alias("rows"))
    times = materialize(times, "times")
    out = packed(docs).join(times, ["_h1", "_h2"])
    if times.where("rows > 1").limit(1).count():  # equal rows: their copies are counted together
        out = out.dropDuplicates(["_h1", "_h2"])
    return out.select("_row", F.explode(F.sequence(F.lit(1), "times"))).select("_row.*")
