"""SimHash near-duplicates through segment bit counts.

A text's fingerprint has bit k set if more than half of its shingles' XXH64 hashes have.
Equal fingerprints are joined first. A distinct fingerprint is then mapped to the bit
counts of its 16 segments of 4 bits. The Manhattan distance of two such vectors is never
above the fingerprints' bit distance, so fingerprints within 2 bits have vectors within 2.
Vectors live on an integer grid: each takes its own cell and those one step away, and two
vectors within 2 steps always meet in a cell. Within a cell every pair is verified by its
exact bit distance.

A cell of more than ``CELL`` fingerprints (a large group of near copies) isn't paired.
Its fingerprints take the 64 bit strings at distance 1 and their own instead: two that
are within 2 bits share one, and all that share one (65 at most) are within 2 bits, so
linking each to the smallest loses no component and needs no pairs.

Defined cases: null and empty texts have fingerprint 0, linked like any other; a
component's id is its smallest non-null doc_id, null if it has none; repeated rows are
one component; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catloss.llm.common import components, materialize, maybe_broadcast, packed, row_hash, text_or_empty

SHINGLE = 3
BITS = 2
SEED = 42
CELL = 48
BLOCK = 1 << 16  # shingles whose bits are counted at once


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    words = text.lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), "int64", len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - width + 1)
    spans = zip(starts[:n].tolist(), ends[len(words) - n :].tolist())
    counts = np.zeros(64, "int64")
    h = xxhash.xxh64_intdigest
    hashes = np.fromiter((h(line[a:b], SEED) for a, b in spans), "uint64", n)
    for k in range(0, n, BLOCK):
        bits = np.unpackbits(hashes[k : k + BLOCK].astype("<u8").view("u1").reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype="int64")
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little", signed=True)


def fingerprints(docs: DataFrame, keys: list[str], width: int = SHINGLE) -> DataFrame:
    """Rows (keys..., fp long)."""
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.select(*keys).schema)

    def run(batches):
        for b in batches:
            fp = [fingerprint(x, width) for x in b.column("_t").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keys), pa.array(fp, pa.int64())], [*keys, "fp"])

    return docs.select(*keys, text_or_empty().cast("binary").alias("_t")).mapInArrow(run, f"{types}, fp long")


def _segment_counts(fp: str) -> Column:
    """Bit counts of the 16 segments, 4 bits each, in one long (halves apart, so that no sum overflows)."""

    def half(x: Column) -> Column:
        two = x.bitwiseAND(F.lit(0x55555555)) + F.shiftright(x, 1).bitwiseAND(F.lit(0x55555555))
        return two.bitwiseAND(F.lit(0x33333333)) + F.shiftright(two, 2).bitwiseAND(F.lit(0x33333333))

    low, high = F.col(fp).bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(fp, 32)
    return F.shiftleft(half(high), 32).bitwiseOR(half(low))


def _cells(distinct: DataFrame) -> DataFrame:
    c = F.col("own")
    near = [F.when(F.shiftright(c, 4 * s).bitwiseAND(F.lit(15)) > 0, c - F.lit(1 << 4 * s)) for s in range(16)]
    near += [F.when(F.shiftright(c, 4 * s).bitwiseAND(F.lit(15)) < 4, c + F.lit(1 << 4 * s)) for s in range(16)]
    cells = F.array_compact(F.array(c, *near))
    return distinct.select("fp", _segment_counts("fp").alias("own")).select("fp", F.explode(cells).alias("cell"))


def links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints within BITS bits into their components."""
    cells = _cells(distinct)
    shared = materialize(cells.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1"), "cells")
    small = cells.join(maybe_broadcast(shared.where(F.col("n") <= CELL)), "cell").groupBy("cell").agg(F.collect_list("fp").alias("l"))
    pair = F.flatten(F.transform("l", lambda x: F.transform(
        F.filter("l", lambda y: (y > x) & (F.bit_count(x.bitwiseXOR(y)) <= BITS)), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    found = small.select(F.explode(pair).alias("p")).select("p.a", "p.b")
    crowded = cells.join(maybe_broadcast(shared.where(F.col("n") > CELL)), "cell").select("fp").distinct()
    variants = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(1 << k if k < 63 else -(1 << 63))) for k in range(64)])
    stars = crowded.select("fp", F.explode(variants).alias("v")).groupBy("v").agg(F.min("fp").alias("a"), F.collect_list("fp").alias("l"))
    stars = stars.where(F.size("l") > 1).select("a", F.explode("l").alias("b")).where("a != b")
    return found.union(stars)


def groups(marked: DataFrame) -> DataFrame:
    """Add g, a label that the rows of a component share, to rows with fp."""
    found = components(links(marked.select("fp").distinct()))
    named = maybe_broadcast(found.select(F.col("node").alias("fp"), "root"))
    return marked.join(named, "fp", "left").withColumn("g", F.coalesce("root", "fp")).drop("root")


def near_duplicates(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """Rows (doc_id, fp, component_id)."""
    marked = groups(materialize(fingerprints(docs, ["doc_id"], width), "fingerprints"))
    marked = materialize(marked, "groups")
    several = marked.groupBy("g").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    return marked.join(maybe_broadcast(several), "g", "left").select("doc_id", "fp", F.coalesce("first", "doc_id").alias("component_id"))


def keep_first(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """One document of each component, that with the smallest doc_id (null last), with its columns."""
    hashed = docs.select("doc_id", "text", *row_hash(docs))
    marked = groups(materialize(fingerprints(hashed, ["doc_id", "_h1", "_h2"], width), "fingerprints"))
    best = marked.groupBy("g").agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("_h1"), F.col("_h2"))).alias("w"), F.count("*").alias("n"))
    best = materialize(best.select("w._h1", "w._h2", "n"), "kept")
    kept = packed(docs).join(best.select("_h1", "_h2"), ["_h1", "_h2"], "left_semi")
    equal = marked.groupBy("_h1", "_h2").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
    return (kept.dropDuplicates(["_h1", "_h2"]) if equal else kept).select("_row.*")
