"""Language-model scores from Elias-Fano n-gram tries.

The model is a bigram model over the training texts' words, each text closed by an end
token. Words get P1 = (c - D) / N + D * V / N / (V + 1) (absolute discounting against the
uniform distribution of all V words and one unknown, D from the counts of counts); a word
after another P = (1 - L) * P1 + L * c(first, word) / c(first), with L from deleted
interpolation. As the logarithm of P is that of P1 plus that of P / P1, the tries hold the
second part, quantised downwards to a byte, for every bigram of the training texts; those
that never occurred add log10(1 - L). But for the quantisation, P sums to 1.

Nothing of the model is held in one place. Words are dealt to shards by their hash and a
shard holds its words' counts and a trie of the bigrams that end in them; a frequent word
(of over an eighth of a shard's tokens) is dealt by the first word too. Texts are tokenised
where they lie; what a batch asks of a shard (distinct bigrams, and the documents that have
them, by their place in the batch) goes there as one binary row, and what comes back is a row
of sums per document; the documents' keys travel once, past the shards. A shard's bigrams are
moved twice: merged beside its counts, and once more to meet the counts of their first words.
All shards' counts cover all training texts, and the number of shards grows with the text.

Words are known by 64-bit hashes, words inside bigrams by 40 bits of them. Defined cases:
a null or empty text is the end token alone; a null doc_id belongs to no training text;
repeated rows get equal scores; with nothing to learn from, every score is that of
unknown words; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catloss.llm.common import materialize, maybe_broadcast, remove, text_or_empty
from catloss.llm.elias_fano import Trie

SHARD_CHARS = 10_000_000
END = xxhash.xxh64_intdigest(b" ")  # no word has a space; a text's first word comes after an end
SHIFT = np.uint64(24)  # 40 bits of a hash remain
AT_ONCE = 2_500_000  # bytes of text that a task holds as tokens, unless one text is longer
BATCH_BYTES = 4_000_000  # of an Arrow batch
ASKED_AT_ONCE = 200_000  # bigrams that a shard looks up together


class Batch:
    """Tokens of a batch of texts: hashes of the distinct words, and (text, word, first word) of each token."""

    def __init__(self, texts: pa.Array):
        # lowered before the cast: pyarrow 23's ascii_lower misreads a slice that was cast, whose bytes begin later
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts).cast(pa.large_string()))
        coded = split.flatten().dictionary_encode()
        known = coded.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        hashes = np.array([*map(xxhash.xxh64_intdigest, known), END], "uint64")
        by_hash = np.argsort(hashes)  # words are numbered in the order of their hashes
        self.hashes = hashes[by_hash]
        number = np.empty(len(hashes), "int64")
        number[by_hash] = np.arange(len(hashes))
        ids = coded.indices.to_numpy(zero_copy_only=False).astype("int64")
        ends = split.offsets.to_numpy() - split.offsets[0].as_py()
        doc = np.repeat(np.arange(len(texts)), np.diff(ends))
        empty = next((i for i, w in enumerate(known) if not w), -1)  # of gaps at a text's ends
        if empty >= 0:
            ids, doc = ids[ids != empty], doc[ids != empty]
        n = np.bincount(doc, minlength=len(texts)) + 1
        stop = np.cumsum(n)
        self.word = np.full(stop[-1] if len(n) else 0, number[-1], "int64")
        closing = np.zeros(len(self.word), bool)
        closing[stop - 1] = True
        self.word[~closing] = number[ids]
        self.first = np.concatenate([[0], self.word[:-1]]) if len(self.word) else self.word
        self.first[stop - n] = number[-1]
        self.doc = np.repeat(np.arange(len(texts)), n)


def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of AT_ONCE bytes of text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + AT_ONCE, "right")))
        to = min(to, at + (1 << 16))
        yield batch.slice(at, to - at)
        _freed(None)
        at = to


def _deal(word: np.ndarray, first: np.ndarray, shards: int, heavy: np.ndarray) -> np.ndarray:
    shard = (word >> np.uint64(40)) % np.uint64(shards)
    if len(heavy):
        shard = np.where(np.isin(word, heavy), ((word ^ first) >> SHIFT) % np.uint64(shards), shard)
    return shard.astype(np.min_scalar_type(shards))  # few bytes are sorted fast


def _planes(*arrays: np.ndarray) -> bytes:
    """Arrays one after the other, each with its length; planes of like bytes compress well."""
    return b"".join(len(a).to_bytes(8, "little") + a.dtype.str.encode().ljust(4) + a.tobytes() for a in arrays)


def _unplanes(data: bytes | memoryview) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        n, kind = int.from_bytes(data[at : at + 8], "little"), np.dtype(bytes(data[at + 8 : at + 12]).decode().strip())
        out.append(np.frombuffer(data, kind, n, at + 12))
        at += 12 + n * kind.itemsize
    return out


def _small(x: np.ndarray) -> np.ndarray:
    """Counts in as few bytes as the largest needs."""
    return x.astype(np.min_scalar_type(int(x.max())) if len(x) else "u1")


def _split40(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return x.astype("<u4"), (x >> np.uint64(32)).astype("u1")


def _join40(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return low.astype("uint64") | high.astype("uint64") << np.uint64(32)


def _by_shard(shard: np.ndarray) -> Iterator[tuple[int, slice]]:
    """For sorted shards: each with its slice."""
    at, begin = np.unique(shard, return_index=True)
    for s, a, b in zip(at, begin, np.append(begin[1:], len(shard))):
        yield int(s), slice(a, b)


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of an array with equal values side by side: the values, and how often each follows."""
    begin = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, "int64")
    return x[begin], np.diff(np.append(begin, len(x)))


def _summed(keys: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Sums of n by equal keys, sorted by the keys."""
    order = np.lexsort(keys[::-1])
    keys, n = [k[order] for k in keys], n[order]
    new = np.ones(len(n), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    begin = np.flatnonzero(new)
    return [k[begin] for k in keys], np.add.reduceat(n, begin) if len(n) else n


def word_counts(texts: DataFrame, shards: int) -> DataFrame:
    """One row per shard with words: (shard, n, v, n1, n2, counts: hashes and counts)."""

    def count(batches):
        for b in (part for batch in batches for part in parts(batch)):
            t = Batch(b.column("text"))
            n = np.bincount(t.word, minlength=len(t.hashes))
            h, n = t.hashes[n > 0], n[n > 0]
            shard = _deal(h, h, shards, np.zeros(0, "uint64"))
            order = np.argsort(shard, kind="stable")  # by hash already
            h, n, shard = h[order], n[order], shard[order]
            rows = [(s, _planes(h[at], _small(n[at]))) for s, at in _by_shard(shard)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["shard", "data"])

    def merge(pdf):
        h, n = (np.concatenate(x) for x in zip(*map(_unplanes, pdf["data"])))
        (h,), n = _summed([h], n.astype("int64"))
        return pd.DataFrame({"shard": pdf["shard"].iloc[:1].values, "n": [n.sum()], "v": [len(n)], "n1": [(n == 1).sum()], "n2": [(n == 2).sum()], "counts": [_planes(h, n)]})

    return texts.select("text").mapInArrow(count, "shard long, data binary").groupBy("shard").applyInPandas(merge, "shard long, n long, v long, n1 long, n2 long, counts binary")


def frequent(counts: DataFrame, least: int) -> dict[int, int]:
    """Words of more than ``least`` tokens and their counts: as few as total / least, a bound that the caller sets."""

    def pick(batches):
        for pdf in batches:
            for data in pdf["counts"]:
                h, n = _unplanes(data)
                yield pd.DataFrame({"h": h[n > least].view("int64"), "n": n[n > least]})

    return {r["h"] & (1 << 64) - 1: r["n"] for r in counts.select("counts").mapInPandas(pick, "h long, n long").collect()}


def bigram_counts(texts: DataFrame, counts: DataFrame, shards: int, heavy: np.ndarray) -> DataFrame:
    """One row per shard: (shard, counts, pairs: distinct words, how many pairs each has, first words, counts)."""

    def count(batches):
        for b in (part for batch in batches for part in parts(batch)):
            t = Batch(b.column("text"))
            size = len(t.hashes)
            pair, n = np.unique(t.word * size + t.first, return_counts=True)
            word, first = t.hashes[pair // size], t.hashes[pair % size]
            shard = _deal(word, first, shards, heavy)
            word, first = word >> SHIFT, first >> SHIFT
            order = np.argsort(shard, kind="stable")  # by word and first word already
            word, first, n, shard = word[order], first[order], n[order], shard[order]
            rows = []
            for s, at in _by_shard(shard):
                w, runs = _runs(word[at])
                rows.append((s, _planes(*_split40(w), _small(runs), *_split40(first[at]), _small(n[at]))))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["shard", "data"])

    def merge(left, right):
        words, firsts, seen = [], [], []
        for data in left["data"]:
            w0, w1, runs, f0, f1, n = _unplanes(data)
            words.append(np.repeat(_join40(w0, w1), runs))
            firsts.append(_join40(f0, f1))
            seen.append(n.astype("<u4"))
        shard = (left if len(left) else right)["shard"].iloc[0]
        del left
        pairs = _planes(*[np.zeros(0, "u1")] * 6)
        if words:
            (w, f), n = _summed([np.concatenate(words), np.concatenate(firsts)], np.concatenate(seen).astype("int64"))
            w, runs = _runs(w)
            pairs = _planes(*_split40(w), _small(runs), *_split40(f), _small(n))
        own = right["counts"].iloc[0] if len(right) else _planes(np.zeros(0, "uint64"), np.zeros(0, "int64"))
        return _freed(pd.DataFrame({"shard": [shard], "counts": [own], "pairs": [pairs]}))

    dealt = texts.select("text").mapInArrow(count, "shard long, data binary")
    return dealt.groupBy("shard").cogroup(counts.select("shard", "counts").groupBy("shard")).applyInPandas(merge, "shard long, counts binary, pairs binary")


def _freed(x):
    """What is given, with Arrow's unused memory back at the system: workers live on from one shard to the next."""
    pa.default_memory_pool().release_unused()
    return x


def _cells(batch: pa.RecordBatch) -> Iterator[list]:
    """The rows of a batch, one at a time; binary values stay where Arrow holds them."""
    for i in range(batch.num_rows):
        yield [memoryview(c[i].as_buffer()) if pa.types.is_binary(c.type) else c[i].as_py() for c in batch.columns]


def _pairs(data: bytes | memoryview) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a shard's bigrams: the distinct words, how many pairs each has, first words, counts."""
    w0, w1, runs, f0, f1, n = _unplanes(data)
    return _join40(w0, w1), runs, _join40(f0, f1), n


def _look(h40: np.ndarray, counts: list[np.ndarray], shift: bool = True) -> np.ndarray:
    """Counts of words by their sorted hashes; 0 for those that aren't there."""
    h, n = counts
    h = h >> SHIFT if shift else h
    if not len(h):
        return np.zeros(len(h40), "int64")
    at = np.minimum(np.searchsorted(h, h40), len(h) - 1)
    return np.where(h[at] == h40, n[at], 0)


class Smoothing:
    """Totals of the model, small enough for every task."""

    def __init__(self, n: int, v: int, n1: int, n2: int):
        self.n, self.v = n, v
        self.discount = min(0.9, max(0.1, n1 / (n1 + 2 * n2))) if n1 and n2 else 0.5
        self.share = 0.0

    def p1(self, c: np.ndarray) -> np.ndarray:
        if not self.n:
            return np.ones(len(c))  # V = 0: the one unknown word
        rest = self.discount * self.v / self.n / (self.v + 1)
        return np.where(c > 0, (c - self.discount) / self.n, 0.0) + rest

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.1) / (self.n + 0.1 * (self.v + 1)))


def _counts_of(word: np.ndarray, counts: list[np.ndarray], heavy: dict[int, int], cut: bool) -> np.ndarray:
    """Counts of a shard's words, with the frequent words that were dealt to it."""
    n = _look(word, counts, cut)
    if heavy:
        names = np.array(sorted(heavy), "uint64")
        n = np.maximum(n, _look(word, [names, np.array([heavy[int(x)] for x in names], "int64")], cut))
    return n


def with_first_counts(pairs: DataFrame, shards: int, s: Smoothing, heavy: dict[int, int]) -> DataFrame:
    """Add first_counts, the count of each pair's first word (one request and one answer between two
    shards), and votes, the tokens whose bigram deleted interpolation prefers."""

    def ask(batches):
        for b in batches:
            for shard, data in _cells(b):
                names = np.unique(_pairs(data)[2])
                to = ((names >> np.uint64(16)) % np.uint64(shards)).astype("int64")
                order = np.argsort(to, kind="stable")
                names, to = names[order], to[order]
                rows = [(t, _planes(*_split40(names[at]))) for t, at in _by_shard(to)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([r[0] for r in rows], pa.int64()), pa.array([shard] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["to", "shard", "names"])

    def answer(left, right):
        counts = _unplanes(right["counts"].iloc[0]) if len(right) else [np.zeros(0, "uint64"), np.zeros(0, "int64")]
        out = []
        for shard, data in zip(left["shard"], left["names"]):
            low, high = _unplanes(data)
            out.append((shard, _planes(low, high, _small(_look(_join40(low, high), counts)))))
        return pd.DataFrame(out, columns=["shard", "got"])

    def attach(left, right):
        if not len(left):
            return pd.DataFrame({"shard": [], "counts": [], "pairs": [], "first_counts": [], "votes": []})
        got = [_unplanes(x) for x in right["got"]]
        names = np.concatenate([_join40(*g[:2]) for g in got]) if got else np.zeros(0, "uint64")
        n = np.concatenate([g[2] for g in got]) if got else np.zeros(0, "int64")
        order = np.argsort(names)
        word, runs, first, seen = _pairs(left["pairs"].iloc[0])
        first = _look(first, [names[order], n[order].astype("int64")], False)
        c = np.repeat(_counts_of(word, _unplanes(left["counts"].iloc[0]), heavy, True), runs)
        seen = seen.astype("int64")
        two = (seen - 1) / np.maximum(first - 1, 1) > (c - 1) / max(s.n - 1, 1)
        return _freed(left.assign(first_counts=[_planes(_small(first))], votes=[int(seen[two].sum())]))

    asked = pairs.select("shard", "pairs").mapInArrow(ask, "to long, shard long, names binary")
    answered = asked.groupBy("to").cogroup(pairs.select(F.col("shard").alias("to"), "counts").groupBy("to")).applyInPandas(answer, "shard long, got binary")
    return pairs.groupBy("shard").cogroup(answered.groupBy("shard")).applyInPandas(
        attach, "shard long, counts binary, pairs binary, first_counts binary, votes long")


def tries(pairs: DataFrame, s: Smoothing, heavy: dict[int, int]) -> DataFrame:
    """Rows (shard, counts, trie), built where the bigrams lie."""

    def build(batches):
        for b in batches:
            for shard, own, data, firsts in _cells(b):
                word, runs, f, n = _pairs(data)
                p1 = np.repeat(s.p1(_counts_of(word, _unplanes(own), heavy, True)), runs)
                v = np.log10(1 - s.share + s.share * n / np.maximum(_unplanes(firsts)[0], 1) / p1)
                trie = Trie.pack(np.repeat(word, runs), f, v)
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([own], pa.binary()), pa.array([trie], pa.binary())], ["shard", "counts", "trie"])

    return pairs.select("shard", "counts", "pairs", "first_counts").mapInArrow(build, "shard long, counts binary, trie binary")


def questions(docs: DataFrame, shards: int, heavy: np.ndarray) -> DataFrame:
    """Rows (shard, block, data): what a batch of texts (key, text) asks of a shard, and one row of the batch's keys alone."""

    def ask(batches):
        for batch in batches:
            for b in parts(batch):
                k = b.column("key").to_numpy(zero_copy_only=False).astype("int64")
                t = Batch(b.column("text"))
                size, many = len(t.hashes), len(k)
                item, times = np.unique((t.word * size + t.first) * many + t.doc, return_counts=True)
                pair, doc = item // many, item % many
                pair, docs_of = _runs(pair)
                word, first = t.hashes[pair // size], t.hashes[pair % size]
                shard = _deal(word, first, shards, heavy)
                order = np.argsort(shard, kind="stable")  # by word and first word already
                begin = np.concatenate([[0], np.cumsum(docs_of)[:-1]]).astype("int64")
                of = docs_of[order]
                at = np.repeat(begin[order] - np.concatenate([[0], np.cumsum(of)[:-1]]), of) + np.arange(of.sum())
                word, first, shard, doc, times = word[order], first[order] >> SHIFT, shard[order], doc[at].astype("<u2"), times[at]
                ends = np.cumsum(of)
                block = xxhash.xxh64_intdigest(k.tobytes()) >> 1
                rows = [(block % shards, block, _planes(k))]
                for sh, x in _by_shard(shard):
                    w, runs = _runs(word[x])
                    d = slice(ends[x.start] - of[x.start], ends[x.stop - 1])
                    rows.append((sh, block, _planes(w, _small(runs), *_split40(first[x]), _small(of[x]), doc[d], _small(times[d]))))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.binary()))], ["shard", "block", "data"])

    return docs.mapInArrow(ask, "shard long, block long, data binary")


def score_texts(docs: DataFrame, training: Column) -> DataFrame:
    """Rows (doc_id, n_tokens, n_known, train_tokens, base_score, score) of all texts, learning from those marked training."""
    text = text_or_empty()
    chars = docs.agg(F.sum(F.length(text))).first()[0] or 0
    shards = max(4, math.ceil(chars / SHARD_CHARS))
    learn = docs.where(F.coalesce(training, F.lit(False))).select(text.alias("text"))

    counts = materialize(word_counts(learn, shards), "words", BATCH_BYTES)
    total = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "v", "n1", "n2")]).first()
    s = Smoothing(*total)
    heavy = frequent(counts, s.n // (8 * shards))  # 8 * shards words at most
    names = np.array(sorted(heavy), "uint64")
    merged = materialize(bigram_counts(learn, counts, shards, names), "bigrams", BATCH_BYTES)
    remove(counts)
    pairs = materialize(with_first_counts(merged, shards, s, heavy), "bigrams", BATCH_BYTES)
    remove(merged)
    votes = pairs.agg(F.sum("votes")).first()[0] or 0
    s.share = min(0.9, votes / s.n) if s.n else 0.0  # of the bigrams, by deleted interpolation
    model = materialize(tries(pairs, s, heavy), "tries", BATCH_BYTES)
    remove(pairs)

    def answer(left, right):
        trie = Trie(right["trie"].iloc[0]) if len(right) else None
        own = _unplanes(right["counts"].iloc[0]) if len(right) else [np.zeros(0, "uint64"), np.zeros(0, "int64")]
        unseen = math.log10(1 - s.share)
        out, held, size = [], [], 0

        def together() -> None:
            """Answer the questions of several batches at once."""
            w, runs, f0, f1, of, doc, times = (np.concatenate(x) for x in zip(*(planes for _, planes in held)))
            first, c = _join40(f0, f1), _counts_of(w, own, heavy, False)
            add = trie.find(w >> SHIFT, runs, first, unseen) if trie else np.full(len(first), unseen)
            one = np.repeat(np.repeat(np.log10(s.p1(c)), runs) + add, of) * times
            c, base = np.repeat(np.repeat(c > 0, runs), of), np.repeat(np.repeat(s.base(c), runs), of) * times
            to = 0
            for block, planes in held:
                at = slice(to, to + len(planes[5]))
                to = at.stop
                most = int(doc[at].max()) + 1
                per = lambda x: np.bincount(doc[at], x[at], most)
                n = per(times).astype("int64")
                has = np.flatnonzero(n)
                out.append((block, _planes(has.astype("<u2"), _small(n[has]), _small(per(c * times)[has].astype("int64")), per(base)[has], per(one)[has])))

        for block, data in zip(left["block"], left["data"]):
            planes = _unplanes(data)
            if len(planes) == 1:  # the batch's keys, on their way to its sums
                out.append((block, data))
                continue
            held.append((block, planes))
            size += len(planes[2])
            if size > ASKED_AT_ONCE:
                together()
                held, size = [], 0
        if held:
            together()
        return _freed(pd.DataFrame(out, columns=["block", "sums"]))

    def add(pdf):
        rows = [_unplanes(x) for x in pdf["sums"]]
        of_batch = next(x[0] for x in rows if len(x) == 1)
        doc, *x = (np.concatenate(c) for c in zip(*(r for r in rows if len(r) > 1)))
        keys, at = np.unique(of_batch[doc], return_inverse=True)
        n, known, base, score = (np.bincount(at, y, len(keys)) for y in x)
        return pd.DataFrame({"key": keys, "n_tokens": n.astype("int64"), "n_known": known.astype("int64"), "base_score": base, "score": score})

    key = F.xxhash64("doc_id", text)
    asked = questions(docs.select(key.alias("key"), text.alias("text")), shards, names)
    sums = asked.groupBy("shard").cogroup(model.groupBy("shard")).applyInPandas(answer, "block long, sums binary")
    scores = sums.groupBy("block").applyInPandas(add, "key long, n_tokens long, n_known long, base_score double, score double")
    sums = ["n_tokens", "n_known", "base_score", "score"]
    scores = materialize(scores.groupBy("key").agg(*[F.sum(c).alias(c) for c in sums]), "scores", BATCH_BYTES)
    remove(model)
    # equal rows have one key and were summed together
    rows = materialize(docs.select("doc_id", key.alias("key")), "rows")
    copies = rows.groupBy("key").agg(F.count("*").alias("copies")).where("copies > 1")
    joined = rows.join(scores, "key").join(maybe_broadcast(copies), "key", "left")
    share = lambda c: F.col(c) / F.coalesce("copies", F.lit(1))
    return joined.select(
        "doc_id", *[F.round(share(c)).cast("long").alias(c) for c in sums[:2]], F.lit(s.n).cast("long").alias("train_tokens"), *[share(c).alias(c) for c in sums[2:]])
