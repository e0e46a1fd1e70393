"""Importance resampling of documents towards a target distribution, by batch concatenation.

A feature is a run of 1 to ``RUN`` consecutive words, joined by a space, in one of
``BUCKETS`` buckets by its CRC-32. Buckets are counted over all documents and over all
target texts; a bucket's gain is the logarithm of its share of the target over its share
of the documents, both with one added to every bucket. A document's weight is the sum of
its features' gains; adding Gumbel noise that its id fixes and drawing the highest scores
samples documents without replacement in proportion to their weights.

A task joins the texts of a batch with separators (``SENTINEL``, in no word), finds all words of the batch
in one regular-expression pass, and looks up the words' positions among the documents'
offsets (``searchsorted``), which masks the runs that cross from one document into the next
before ``bincount``. Runs' CRCs go on from those of the runs one word shorter. Each task
sends one row a bucket, so shuffles and the driver see ``BUCKETS`` rows however large the
corpus; ranks come from running counts over range partitions of narrow rows.

Defined cases: null and empty texts have no words and weight 0; a text above a mebibyte
is read in pieces that carry the last words over, with the same result; equal scores rank
by smaller id, null ids last; repeated rows rank separately, in any order among
themselves; an empty table, or one without a document of ``LEAST_WORDS`` words, draws
nothing; without target texts all gains come from the documents alone; further columns,
whatever their names, are ignored by ``rank_documents`` and kept by ``draw``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catloss.llm.common import materialize, packed, running_total
from catloss.llm.words import WORD, pieces

BUCKETS = 10_000
RUN = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
SENTINEL = b"\n"


def features(held: list[tuple[int, bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece and bucket of each feature, words of each piece) of pieces (text number, bytes, words carried over)."""
    lengths = [len(data) + len(SENTINEL) for _, data, _ in held]
    offsets = np.cumsum([0, *lengths[:-1]])
    found = [(m.start(), m.group()) for m in WORD.finditer(SENTINEL.join([data for _, data, _ in held]))]
    if not found:
        none = np.zeros(0, "int64")
        return none, none, np.zeros(len(held), "int64")
    at, words = zip(*found)
    piece = np.searchsorted(offsets, np.array(at), "right") - 1
    n = np.bincount(piece, minlength=len(held))
    lead = np.array([k for _, _, k in held])
    # a run counts in the piece that its last word is new in
    new = np.arange(len(words)) - np.repeat(np.cumsum(n) - n, n) >= lead[piece]
    after = [b" " + w for w in words]
    run, pieces_of, buckets = list(map(crc32, words)), [], []
    for k in range(RUN):
        whole = new[k:] & (piece[k:] == piece[: len(piece) - k])
        pieces_of.append(piece[k:][whole])
        buckets.append(np.array(run, "int64")[whole] % BUCKETS)
        run = list(map(crc32, after[k + 1 :], run))
    return np.concatenate(pieces_of), np.concatenate(buckets), n - lead


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[list[int], tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    for held in pieces(batch.column("text").to_pylist(), carry=RUN - 1):
        yield [i for i, _, _ in held], features(held)


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features in each bucket, over all rows' texts."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(BUCKETS, "int64")
        for batch in batches:
            for _, (_, bucket, _) in _texts(batch):
                n += np.bincount(bucket, minlength=BUCKETS)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype("int32")), pa.array(n[used])], ["bucket", "n"])

    found = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "bucket int, n long")
    out = np.zeros(BUCKETS, "int64")
    for r in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most BUCKETS rows
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket in thousandths, rounded down."""
    s, t = int(source.sum()), int(target.sum())
    return np.array([
        math.floor(1000 * math.log(float((int(b) + 1) * (s + BUCKETS)) / float((int(a) + 1) * (t + BUCKETS)))) for a, b in zip(source, target)
    ], "int64")


def noise(key: str) -> int:
    """Gumbel noise in thousandths that ``key`` fixes."""
    h = int(hashlib.sha256(f"{SEED}:{key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gain: np.ndarray, keys: list[str]) -> DataFrame:
    """Rows (keys, n_words, n_features, weight, score), one per row of ``docs``; the first key seeds the noise."""

    def weighed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n, weight = (np.zeros(batch.num_rows, "int64") for _ in range(3))
            for of, (piece, bucket, n_words) in _texts(batch):
                np.add.at(words, of, n_words)
                np.add.at(n, of, np.bincount(piece, minlength=len(of)))
                sums = np.zeros(len(of), "int64")
                np.add.at(sums, piece, gain[bucket])
                np.add.at(weight, of, sums)
            score = weight + np.array([noise(k) for k in batch.column("_key").to_pylist()], "int64")
            columns = [*(batch.column(k) for k in keys), *map(pa.array, (words, n, weight, score))]
            yield pa.RecordBatch.from_arrays(columns, [*keys, "n_words", "n_features", "weight", "score"])

    key = F.coalesce(F.col(keys[0]).cast("string"), F.lit("null")).alias("_key")
    types = ", ".join(f"{k} {docs.schema[k].dataType.simpleString()}" for k in keys)
    return docs.select(*keys, key, F.col("text").cast("string").alias("text")).mapInArrow(
        weighed, f"{types}, n_words long, n_features long, weight long, score long")


def rank_documents(docs: DataFrame, target: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Rows (keys, n_words, n_features, weight, score, rank); rank is null where a document isn't drawn.

    ``docs`` and ``target`` have a column text; ``keys`` (doc_id) break ties in their order.
    """
    keys = keys or ["doc_id"]
    scored = materialize(weigh(docs, gains(bucket_counts(docs), bucket_counts(target)), keys), "scored")
    enough = F.col("n_words") >= LEAST_WORDS
    drawn = PERCENT * scored.where(enough).count() // 100
    orders = {"_down": -F.col("score")} | {f"_none{i}": F.col(k).isNull() for i, k in enumerate(keys)}
    queued = scored.where(enough).withColumns(orders | {"_one": F.lit(1).cast("long")})
    order = ["_down", *(x for i, k in enumerate(keys) for x in (f"_none{i}", k))]
    ranked = running_total(queued, order, {"_one": "rank"}).drop("_one", *orders)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return ranked.union(scored.where(~enough).withColumn("rank", F.lit(None).cast("long")))


def draw(docs: DataFrame, target: DataFrame) -> DataFrame:
    """The documents drawn, with all their columns; of equal rows as many as are drawn."""
    rows = packed(docs).select("_row", "_h1", "_h2")
    ranked = rank_documents(rows.select(F.col("_row.doc_id").alias("doc_id"), F.col("_row.text").alias("text"), "_h1", "_h2"), target, ["doc_id", "_h1", "_h2"])
    times = ranked.where("rank is not null").groupBy("_h1", "_h2").agg(F.count("*").cast("int").alias("_n"))
    return rows.dropDuplicates(["_h1", "_h2"]).join(times, ["_h1", "_h2"]).select("_row", F.explode(F.sequence(F.lit(1), "_n"))).select("_row.*")
