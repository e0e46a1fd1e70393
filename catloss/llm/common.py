"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catloss.session import ensure_checkpoint_dir

#: ASCII white space; a word is a maximal run of anything else.
WS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: A side is broadcast only when counting has shown that it has at most this many (narrow) rows.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str, batch_bytes: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Later steps read files that every executor sees, so a lost executor costs only
    its running tasks, and plans that use the rows several times don't recompute them.
    The shuffles of the write are not needed after it and go with its end. ``batch_bytes``
    bounds the Arrow batches that reach Python meanwhile.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}-{name}"
    settings = {SHUFFLES_GO: "true"} | ({BATCH_BYTES: str(batch_bytes)} if batch_bytes else {})
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


def remove(*written: DataFrame) -> None:
    """Delete the files of materialized tables that nothing reads any more."""
    for df in written:
        spark = df.sparkSession
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def maybe_broadcast(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if counting finds at most ``most`` rows; else leave the join to Spark (sort-merge, split by AQE)."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def running_total(df: DataFrame, order: Sequence[str], sums: dict[str, str], parts: int | None = None) -> DataFrame:
    """For each ``value: name`` of sums add the sum of ``value`` over all rows up to this one in ``order``.

    Range partitions of balanced size hold the order, so a hot key costs no more than
    other rows. They are written once (their bounds come from a sample and could differ
    when recomputed), each partition's total gives the next ones' offsets, and each
    partition is then walked in order. ``order`` must be total for a repeatable result. A
    null value adds nothing.
    """
    parts = parts or shuffle_width(df.sparkSession)
    ranged = df.repartitionByRange(parts, *[F.col(c) for c in order]).withColumn("_pid", F.spark_partition_id())
    ranged = materialize(ranged, "ranged")
    totals = ranged.groupBy("_pid").agg(*[F.sum(v).alias(n) for v, n in sums.items()])
    before, start = dict.fromkeys(sums.values(), 0), {}
    for r in totals.orderBy("_pid").collect():  # one row a partition
        start[r["_pid"]] = dict(before)
        before = {n: before[n] + (r[n] or 0) for n in before}

    def walk(batches):
        pid, at = None, {}
        for b in batches:
            pids = b.column("_pid").to_numpy()
            cum = {n: np.zeros(len(pids), "int64") for n in sums.values()}
            values = {n: pc.fill_null(b.column(v), 0).cast(pa.int64()).to_numpy() for v, n in sums.items()}
            cuts = [0, *(np.flatnonzero(np.diff(pids)) + 1), len(pids)] if len(pids) else []
            for lo, hi in zip(cuts, cuts[1:]):
                if pids[lo] != pid:
                    pid, at = pids[lo], dict(start[int(pids[lo])])
                for n in cum:
                    cum[n][lo:hi] = np.cumsum(values[n][lo:hi]) + at[n]
                    at[n] = int(cum[n][hi - 1])
            kept = [i for i, c in enumerate(b.schema.names) if c != "_pid"]  # as Arrow holds them: no value beside a null changes
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in kept), *map(pa.array, cum.values())], [*(b.schema.names[i] for i in kept), *cum])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), *(f"`{n}` long" for n in sums.values())])
    return ranged.repartition(parts, "_pid").sortWithinPartitions("_pid", *order).mapInArrow(walk, schema)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected links (a, b: long): rows (node, root), root the smallest node.

    Alternates large-star and small-star steps, which need a logarithmic number of
    rounds; each round's links are written to the shared folder. Only a count and a
    checksum of a round's links reach the driver.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    e = materialize(e, "links")
    sign = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
        e = materialize(small.select("x.u", "x.v").where("u != v").distinct(), "links")
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(now) == sign:
            break
        sign = tuple(now)
    roots = e.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def sliced(batch: pa.RecordBatch, most: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``most`` bytes of text, or of one longer text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def per_process(key: tuple, make: Callable[[], object]) -> object:
    """What ``make`` returns, made once in a worker process: modules sent with the plan are new in every task."""
    held = sys.__dict__.setdefault("_catloss_held", {})
    if key not in held:
        held.clear()  # one at a time
        held[key] = make()
    return held[key]


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join that also matches nulls; the right side's keys are dropped."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        on = c if on is None else on & c
    return left.join(r, on, how).drop(*[f"_r_{k}" for k in keys])


def packed(df: DataFrame) -> DataFrame:
    """The rows as one struct _row beside their hashes, so that no column name can clash."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), *row_hash(df))


def row_hash(df: DataFrame) -> list[Column]:
    """Two independent 64-bit hashes of the whole row, as columns _h1 and _h2."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    nulls = [c.isNull() for c in cols]  # the hash itself passes over nulls
    return [F.xxhash64(*cols, *nulls).alias("_h1"), F.xxhash64(F.lit(7), *cols, *nulls).alias("_h2")]
