"""Ranked lexical search by NRA (no random access) over impact-sorted lists.

Documents are cut into shards of bounded size. A shard holds, for each term of the
queries, the list of its documents and term counts; shards are written once to the shared
folder. When all shards' counts have been added up (documents N, terms L, documents of each
term df), a task sorts a shard's lists by impact and answers every query on it by NRA: in
rounds, the next postings of each of the query's lists are read, in order. A document's
score is at least the sum of what was read of it (its lower bound) and at most that plus
the next impact of every list in which it wasn't read (its upper bound). Reading goes on
until no unread document can reach the best ``k`` any more, every document that still can
has its final score, and so ties are settled too; lists are abandoned unread where even
their first impacts can't reach. The ``k``-th best score of the shards before carries
over within a task, so most of a later shard's postings stay unread.

All arithmetic is in 64-bit integers. A term in df of N documents weighs
w = floor(1000 ln((2N + 2) / (2df + 1))); its impact on a document with tf of it among n
terms is 10^9 tf div (1000 tf + 8m), with m = 100 - ``LENGTH`` + (LENGTH n N) div L; a score
is the sum of w times impact over the query's terms, repeats included.

Queries are a stated set: they are taken in blocks of ``BLOCK`` bytes of text, each of which
is answered against all documents; nothing of the documents but df of the block's terms
reaches the driver, and of the results only ``k`` rows a query and task are shuffled.

Defined cases: null and empty texts have no terms; a document without terms isn't counted
in N and is never found; a query without terms finds nothing; equal scores rank by smaller
id, null ids last; repeated rows are documents, or queries, of their own; a text of any
length is read whole, in pieces of a mebibyte; an empty table gives no rows; further
columns are ignored whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catloss.llm.common import materialize
from catloss.llm.words import WORD, pieces

BEST = 10
LENGTH = 75
SHARD_DOCS = 8192
SHARD_POSTINGS = 500_000
BLOCK = 1 << 20
STEP = 64  # postings read of each list in the first round; every next round reads twice as many


def terms(text: str | None) -> Counter:
    found: Counter = Counter()
    for held in pieces([text]):
        for _, data, _ in held:
            found.update(WORD.findall(data))
    return found


def query_blocks(queries: DataFrame, id_column: str) -> Iterator[list[tuple[object, Counter]]]:
    """Queries (id, terms) in blocks of about BLOCK bytes of text; the driver holds one partition's rows at a time."""
    block, size = [], 0
    for r in queries.select(id_column, F.col("text").cast("string").alias("text")).toLocalIterator():
        block.append((r[0], terms(r[1])))
        size += len(r[1] or "") + 1
        if size >= BLOCK:
            yield block
            block, size = [], 0
    if block:
        yield block


def index(docs: DataFrame, vocabulary: dict[bytes, int], id_column: str) -> DataFrame:
    """One row per shard: documents and terms counted, and the lists of the vocabulary's terms, one after the other.

    ids and lengths belong to the shard's documents that hold a term; term, document (its
    place in ids) and tf are parallel, sorted by term.
    """
    id_type = docs.schema[id_column].dataType

    def shard(n_docs, n_terms, ids, lengths, rows):
        doc, term, tf = (np.concatenate(x) if x else np.zeros(0, "int32") for x in zip(*rows)) if rows else [np.zeros(0, "int32")] * 3
        order = np.argsort(term, kind="stable")
        columns = [pa.array([n_docs]), pa.array([n_terms]), pa.array([ids], pa.list_(arrow)), pa.array([lengths], pa.list_(pa.int64()))]
        columns += [pa.array([x[order]], pa.list_(pa.int32())) for x in (term, doc, tf)]
        return pa.RecordBatch.from_arrays(columns, ["n_docs", "n_terms", "ids", "lengths", "term", "doc", "tf"])

    from pyspark.sql.pandas.types import to_arrow_type

    arrow = to_arrow_type(id_type)

    def count(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(row, terms, distinct query terms, their counts) of each row's whole text."""
        row, n, found = None, 0, Counter()
        for held in pieces(batch.column("text").to_pylist()):
            for i, data, _ in held:
                if i != row:
                    if row is not None:
                        yield row, n, *_arrays(found)
                    row, n, found = i, 0, Counter()
                words = WORD.findall(data)
                n += len(words)
                found.update(map(vocabulary.get, words))
        if row is not None:
            yield row, n, *_arrays(found)

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_docs = n_terms = postings = 0
        ids, lengths, rows = [], [], []
        for batch in batches:
            keys = batch.column("id").to_pylist()
            for i, n, term, tf in count(batch):
                n_docs, n_terms = n_docs + (n > 0), n_terms + n
                if len(term):
                    rows.append((np.full(len(term), len(ids), "int32"), term, tf))
                    ids.append(keys[i])
                    lengths.append(n)
                    postings += len(term)
                if len(ids) >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                    yield shard(n_docs, n_terms, ids, lengths, rows)
                    n_docs = n_terms = postings = 0
                    ids, lengths, rows = [], [], []
        if n_docs:
            yield shard(n_docs, n_terms, ids, lengths, rows)

    return docs.select(F.col(id_column).alias("id"), F.col("text").cast("string").alias("text")).mapInArrow(
        build, f"n_docs long, n_terms long, ids array<{id_type.simpleString()}>, lengths array<long>, term array<int>, doc array<int>, tf array<int>")


def _arrays(found: Counter) -> tuple[np.ndarray, np.ndarray]:
    found.pop(None, None)  # words of no query
    return np.fromiter(found.keys(), "int32", len(found)), np.fromiter(found.values(), "int32", len(found))


class Shard:
    """A shard's lists, each sorted by impact."""

    def __init__(self, ids, lengths: np.ndarray, term: np.ndarray, doc: np.ndarray, tf: np.ndarray, n_docs: int, n_terms: int):
        m = 100 - LENGTH + LENGTH * lengths * n_docs // n_terms
        tf = tf.astype("int64")
        impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[doc])
        order = np.lexsort((doc, -impact, term))
        self.ids, self.doc, self.impact = ids, doc[order], impact[order]
        self.terms, self.begin = np.unique(term, return_index=True)
        self.end = np.append(self.begin[1:], len(term))
        self.place = {int(t): i for i, t in enumerate(self.terms)}

    def search(self, query: Iterable[tuple[int, int]], k: int, floor: int = 0) -> tuple[list[tuple[int, int]], int]:
        """((score, document) of all that may be among the best k and reach floor, postings read) for (term, weight) pairs."""
        lists = []
        for t, w in query:
            if w > 0 and (i := self.place.get(t)) is not None:
                a, b = self.begin[i], self.end[i]
                lists.append((self.doc[a:b], self.impact[a:b], w))
        lower, read, step = np.zeros(len(self.ids), "int64"), 0, STEP
        covered = np.zeros(len(self.ids), "int64")
        while True:
            bounds = [w * int(c[read]) if read < len(c) else 0 for _, c, w in lists]
            unread = sum(bounds)
            best = int(np.partition(lower, -k)[-k]) if len(lower) >= k else 0
            least = max(floor, best, 1)
            covered[:] = 0  # of each document, the bounds of the lists in which it was read
            if read:
                for (d, _, _), bound in zip(lists, bounds):
                    if bound:
                        covered[d[:read]] += bound
            open_ = lower + (unread - covered) >= least
            # documents that were never read have lower 0 and nothing covered: all are open or none is
            if unread < least:
                open_ &= lower > 0
                at = np.flatnonzero(open_)
                if (covered[at] == unread).all():
                    return [(int(lower[i]), int(i)) for i in at], min(read, max((len(d) for d, _, _ in lists), default=0))
            for d, c, w in lists:
                if read < len(d):
                    lower[d[read : read + step]] += w * c[read : read + step]
            read, step = read + step, step * 2


def _order(hit: tuple[int, object]):
    return -hit[0], hit[1] is None, hit[1]


def search(docs: DataFrame, queries: DataFrame, k: int = BEST, id_column: str = "doc_id", query_id: str = "item_id") -> DataFrame:
    """Rows (query_id, rank, id_column, score): each query's k best documents with a score above 0."""
    id_type, query_type = docs.schema[id_column].dataType.simpleString(), queries.schema[query_id].dataType.simpleString()
    found = docs.sparkSession.createDataFrame([], f"{query_id} {query_type}, rank int, {id_column} {id_type}, score long")
    for block in query_blocks(queries, query_id):
        found = found.union(_answer(docs, block, k, id_column, query_id, query_type))
    return found


def _answer(docs: DataFrame, block: list[tuple[object, Counter]], k: int, id_column: str, query_id: str, query_type: str) -> DataFrame:
    spark, id_type = docs.sparkSession, docs.schema[id_column].dataType.simpleString()
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, q in block for t in q}))}
    shards = materialize(index(docs, vocabulary, id_column), "shards")
    total = shards.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n_docs, n_terms = (int(x or 0) for x in total)
    held = shards.select(F.explode("term").alias("term")).groupBy("term").count().collect()  # one row a term of the block
    weight = {r["term"]: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["count"] + 1))) for r in held}
    asked = [[(vocabulary[t], n * weight[vocabulary[t]]) for t, n in q.items() if vocabulary[t] in weight] for _, q in block]

    def answer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, object]]] = [[] for _ in asked]
        for batch in batches:
            for i in range(batch.num_rows):
                term, doc, tf, lengths = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("term", "doc", "tf", "lengths"))
                if not len(term):
                    continue
                shard = Shard(batch.column("ids")[i].as_py(), lengths, term, doc, tf, n_docs, n_terms)
                for q, query in enumerate(asked):
                    floor = best[q][-1][0] if len(best[q]) == k else 0
                    hits, _ = shard.search(query, k, floor)
                    if hits:
                        best[q] = sorted(best[q] + [(s, shard.ids[d]) for s, d in hits], key=_order)[:k]
        rows = [(q, d, s) for q, hits in enumerate(best) for s, d in hits]
        query, doc, score = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(query, pa.int32()), pa.array(doc, arrow), pa.array(score, pa.int64())], ["q", "id", "score"])

    from pyspark.sql.pandas.types import to_arrow_type

    arrow = to_arrow_type(docs.schema[id_column].dataType)
    local = shards.select("ids", "lengths", "term", "doc", "tf").mapInArrow(answer, f"q int, id {id_type}, score long")
    best = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    ranked = local.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(block)], f"q int, name {query_type}")  # the block
    return ranked.join(F.broadcast(names), "q").select(F.col("name").alias(query_id), "rank", F.col("id").alias(id_column), "score")
