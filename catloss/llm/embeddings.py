"""Near-duplicate embeddings by collision counting on sorted projections.

Equal vectors are joined first. Each distinct vector is scaled to length 1 and projected
on random lines, in fixed point, once. Two vectors at cosine ``COSINE`` lie
sqrt(2 - 2 * COSINE) apart, so their projections differ by at most ``WINDOW`` with a known
probability (0.9886 for the values here): that is the query-centred window. In each of
``rounds`` rounds, a few projections with random offsets form a grid of cells ``WIDTH`` wide,
and vectors of one cell meet. There, vectors are sorted by one
projection, whose window ``SORTED`` misses one near pair in 16,000; the pairs in each
other's windows have their collisions on ``COUNTED`` further projections counted, and are
given up as soon as they can't reach ``least_count()``. Pairs that do are verified by their
cosine in double precision. The numbers of rounds and collisions are calibrated to find a
pair at the bound with probability ``RECALL`` each; closer pairs more.

What is dealt to cells is a vector's id and its counted projections (48 bytes), not the
vector: a first pass finds the vectors with a pair that passes the count, and only theirs
are joined and dealt again for the verification. The number of grid projections is the one
that makes pairs tested plus entries dealt least (``grid_shape``). A cell with over
``BLOCK`` vectors is cut into chunks, and every pair of chunks is a group of its own; groups are
read from sorted partitions one after the other, and pairs in slices of ``SLICE``. A pair
counts in the first round in which it meets, so link numbers add up without listing pairs; for the components each group passes on a spanning forest of its
links only.

Defined cases: vectors that are null, zero, or hold null or non-finite components link
with nothing; vectors of different length don't link; a null vec_id is never the smallest
of a component and gets a null component_id where it stands alone; repeated rows are
vectors of their own; an empty table gives no rows; labels and further columns, whatever
their names, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catloss.llm.common import components, materialize, maybe_broadcast, shuffle_width

COSINE = 0.95
WINDOW = 0.8  # in standard deviations of a projection of a random unit vector
SORTED = 4 * math.sqrt(2 - 2 * COSINE)  # four standard deviations of the difference of a pair at the bound
COUNTED = 23
RECALL = 0.999
BLOCK = 1024
SLICE = 1 << 16
SEED = 5
UNIT = 1 << 10  # fixed point: projections are whole multiples of 1 / UNIT
ENTRY_COST = 200  # pairs tested in the time that dealing an entry takes


def hit_rate() -> float:
    """Probability that the projections of two vectors at the bound differ by at most the window."""
    return math.erf(WINDOW / math.sqrt(2 - 2 * COSINE) / math.sqrt(2))


def least_count() -> int:
    """The most collisions out of COUNTED that a pair at the bound still reaches with probability RECALL."""
    p, tail = hit_rate(), 0.0
    for k in range(COUNTED, -1, -1):
        tail += math.comb(COUNTED, k) * p**k * (1 - p) ** (COUNTED - k)
        if tail >= RECALL:
            return k
    return 0


WIDTH = 1.6
#: Share of unrelated pairs in one cell of a grid line: projections of unit vectors are normal.
MEET = WIDTH / (2 * math.sqrt(math.pi))


def same_cell() -> float:
    """Probability that a grid line of random offset has two vectors at the bound in one cell."""
    sd = math.sqrt(2 - 2 * COSINE)
    z = WIDTH / sd
    return math.erf(z / math.sqrt(2)) - math.sqrt(2 / math.pi) / z * (1 - math.exp(-z * z / 2))


def grid_shape(n: int) -> tuple[int, int]:
    """(grid projections per round, rounds) for n distinct vectors: those of the least work."""
    def rounds(k: int) -> int:
        return max(1, math.ceil(math.log(1 - RECALL) / math.log(1 - same_cell() ** k)))

    def work(k: int) -> float:
        return rounds(k) * (MEET**k * n * n / 2 + ENTRY_COST * n)

    k = min(range(1, 33), key=work)
    return k, rounds(k)


def lines(d: int, k: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions of the sorted, the counted and the grid's projections, and the grid's offsets, equal in every task."""
    rng = np.random.default_rng(SEED + d)
    counted = rng.standard_normal((d, 1 + COUNTED))
    return np.hstack([counted, rng.standard_normal((d, rounds * k))]), rng.random(rounds * k) * WIDTH


def _unit(rows) -> np.ndarray:
    x = np.asarray([np.asarray(v, "float64") for v in rows], "float64")
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _project(k: int, rounds: int):
    """Add counted (the sorted and the counted projections, 16 bits each) and grid (cells, 8 bits a line) to (id, d, copies, v)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for pdf in batches:
            for d, rows in pdf.groupby("d"):
                if d not in made:
                    made[d] = lines(int(d), k, rounds)
                for at in range(0, len(rows), 2048):
                    part = rows.iloc[at : at + 2048]
                    p = _unit(part["v"]) @ made[d][0]
                    counted = np.clip(np.rint(p[:, : 1 + COUNTED] * UNIT), -32768, 32767).astype("<i2")
                    grid = np.clip(np.floor((p[:, 1 + COUNTED :] + made[d][1]) / WIDTH), -128, 127).astype("i1")
                    yield part.assign(counted=[x.tobytes() for x in counted], grid=[x.tobytes() for x in grid])

    return run


def _matrix(column: pd.Series, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(len(column), -1)


def _cell_keys(cells: np.ndarray, d: np.ndarray, r: int) -> np.ndarray:
    """64-bit keys of rows of cell coordinates of a round."""
    with np.errstate(over="ignore"):
        h = np.full(len(cells), 0x9E3779B97F4A7C15, "uint64") * (d.astype("uint64") * np.uint64(1024) + np.uint64(r + 1))
        for c in cells.T:
            h = (h ^ c.astype("int64").view("uint64")) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(29)
        h = h * np.uint64(0x94D049BB133111EB)
    return (h ^ (h >> np.uint64(32))).view("int64")


REACH = int(WINDOW * UNIT)


def _entries(k: int, rounds: int):
    """Each vector's cell in each round."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for s in range(0, len(pdf), 1024):
                rows = pdf.iloc[s : s + 1024]
                grid, d = _matrix(rows["grid"], "i1"), rows["d"].to_numpy()
                for r in range(rounds):
                    yield pd.DataFrame({"id": rows["id"], "key": _cell_keys(grid[:, r * k : r * k + k], d, r), "round": r, "counted": rows["counted"]})

    return run


def _groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole groups (key, i, j) of sorted rows, as many at a time as a batch has; a group has two chunks at most."""
    held = None
    for pdf in batches:
        pdf = pd.concat([held, pdf], ignore_index=True) if held is not None else pdf
        if not len(pdf):
            continue
        names = pdf[["key", "i", "j"]].to_numpy()
        cuts = np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1
        last = int(cuts[-1]) if len(cuts) else 0
        if last:
            yield pdf.iloc[:last]
        held = pdf.iloc[last:]
    if held is not None and len(held):
        yield held


def passing(counted: np.ndarray, group: np.ndarray, i: np.ndarray, j: np.ndarray, chunk: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of a group (chunk i with chunk j) that reach the least count, each once, in slices."""
    reach, allowed = int(SORTED * UNIT) + 1, COUNTED - least_count()
    left, right = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j)
    line = (group.astype("int64") << 20) + counted[:, 0]  # one sorted line a group, far apart
    order = right[np.argsort(line[right], kind="stable")]
    low, high = np.searchsorted(line[order], line[left] - reach, "left"), np.searchsorted(line[order], line[left] + reach, "right")
    upto = np.cumsum(high - low)
    start = 0
    while start < len(left):
        end = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + SLICE, "right")))
        n = (high - low)[start:end]
        a = np.repeat(left[start:end], n)
        b = order[np.arange(n.sum()) + np.repeat(low[start:end] - (np.cumsum(n) - n), n)]
        once = (a < b) | (i[a] != j[a])
        a, b = a[once], b[once]
        misses = np.zeros(len(a), "int8")
        for c in range(1, 1 + COUNTED):
            misses += np.abs(counted[a, c].astype("int32") - counted[b, c]) > REACH
            keep = misses <= allowed
            a, b, misses = a[keep], b[keep], misses[keep]
        yield a, b
        start = end


def _pairs(pdf: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    key, i, j, chunk = (pdf[c].to_numpy() for c in ("key", "i", "j", "chunk"))
    new = np.concatenate([[False], (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
    return passing(_matrix(pdf["counted"], "<i2"), np.cumsum(new), i, j, chunk)


def _survivors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of each group that have a pair that passes the count, without their projections."""
    for pdf in _groups(batches):
        hit = np.zeros(len(pdf), bool)
        for a, b in _pairs(pdf):
            hit[a] = hit[b] = True
        yield pdf.loc[hit, ["key", "i", "j", "round", "chunk", "id"]]


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node that links (a, b) join it to."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _links(k: int, rounds: int):
    """Verified links of the groups: per vector its direct links, and a node that it is joined to."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _groups(batches):
            grid = _matrix(pdf["grid"], "i1").reshape(len(pdf), rounds, k)
            ids, at, lengths = (pdf[c].to_numpy() for c in ("id", "round", "d"))
            x = np.zeros((len(pdf), lengths.max()))
            for d in np.unique(lengths):  # vectors of one length have cells of their own
                x[lengths == d, :d] = _unit(pdf["v"][lengths == d])
            pairs = []
            for a, b in _pairs(pdf):
                good = np.einsum("ij,ij->i", x[a], x[b]) >= COSINE
                a, b = a[good], b[good]
                first = (grid[a] == grid[b]).all(axis=2).argmax(axis=1) == at[a]  # the first round in which the pair meets
                pairs.append((a[first], b[first]))
            a, b = (np.concatenate([p[c] for p in pairs]) if pairs else np.zeros(0, "int64") for c in (0, 1))
            if len(a):
                rows, inverse = np.unique(np.concatenate([ids[a], ids[b]]), return_inverse=True)
                copies, u, v = pdf["copies"].to_numpy(), inverse[: len(a)], inverse[len(a) :]
                n = np.bincount(u, copies[b], len(rows)) + np.bincount(v, copies[a], len(rows))
                yield pd.DataFrame({"id": rows, "links": n.astype("int64"), "joined": rows[_forest(len(rows), u, v)]})

    return run


def near_duplicates(rows: DataFrame) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept) for rows (vec_id, embedding)."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    fine = F.col("embedding").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    marked = rows.select("vec_id", "embedding", v.alias("v")).withColumn("fine", F.coalesce(fine, F.lit(False)))
    # a vector's key: two hashes of its components (minus zero as zero)
    plain = F.transform("v", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    marked = materialize(marked.select("vec_id", "fine", F.when(F.col("fine"), plain).alias("v"), F.xxhash64(plain).alias("h1"), F.xxhash64(F.lit(3), plain).alias("h2")), "vectors")
    k, rounds = grid_shape(marked.where("fine").count())
    same = marked.where("fine").groupBy("h1", "h2").agg(F.count("*").alias("copies"), F.first("v").alias("v"))
    same = same.withColumn("id", F.monotonically_increasing_id()).withColumn("d", F.size("v"))
    same = materialize(same.mapInPandas(
        _project(k, rounds), "h1 long, h2 long, copies long, v array<double>, id long, d int, counted binary, grid binary"), "distinct")
    entries = same.select("id", "d", "counted", "grid").mapInPandas(_entries(k, rounds), "id long, key long, round int, counted binary")
    entries = materialize(entries, "entries")
    # cells above BLOCK are cut into chunks
    crowded = materialize(entries.groupBy("key").count().where(F.col("count") > BLOCK).select("key", F.ceil(F.col("count") / BLOCK).cast("int").alias("chunks")), "cells")
    placed = entries.join(maybe_broadcast(crowded), "key", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    placed = placed.withColumn("chunk", F.pmod(F.xxhash64("id"), "chunks").cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    group = ["key", "i", "j"]
    width = shuffle_width(rows.sparkSession)

    def grouped(df: DataFrame) -> DataFrame:
        return df.repartition(width, *group).sortWithinPartitions(*group)

    tasks = placed.select("key", F.least("chunk", "o").alias("i"), F.greatest("chunk", "o").alias("j"), "round", "chunk", "id", "counted")
    near = materialize(grouped(tasks).mapInPandas(_survivors, "key long, i int, j int, round int, chunk int, id long"), "near")
    met = grouped(near.join(same.select("id", "d", "copies", "v", "counted", "grid"), "id"))
    found = materialize(met.mapInPandas(_links(k, rounds), "id long, links long, joined long"), "links")
    comps = components(found.select(F.col("id").alias("a"), F.col("joined").alias("b")))
    direct = found.groupBy("id").agg(F.sum("links").alias("links"))
    named = same.join(direct, "id", "left").join(comps, F.col("id") == F.col("node"), "left").select(
        "h1", "h2", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "id").alias("g"))
    named = named.where("copies > 1 or links > 0")
    labelled = materialize(marked.drop("v").join(maybe_broadcast(named), ["h1", "h2"], "left"), "labelled")
    first = labelled.where("fine and g is not null").groupBy("g").agg(F.min("vec_id").alias("first"))
    linked = F.when(F.col("fine"), F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0))).otherwise(0).cast("long")
    return labelled.join(maybe_broadcast(first), "g", "left").select(
        "vec_id", linked.alias("n_links"), F.when(F.col("fine"), F.coalesce("first", "vec_id")).otherwise(F.col("vec_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
