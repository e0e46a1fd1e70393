"""The dealt operators against brute force, the libraries, and odd inputs."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from catloss.llm import bpe_codec, elias_fano, embeddings, language_crf, licenses, line_dedup, mixing, ngram_lm, quality_rules, simhash, token_counts
from catloss.llm.queries import QUERIES, vocabulary
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row string, kept string, n string"
RNG = random.Random(4)
SYLLABLES = ["ba", "co", "di", "fu", "ga", "he", "li", "mo", "ne", "pi", "ra", "so", "tu"]


def prose(words: int) -> str:
    return " ".join("".join(RNG.choice(SYLLABLES) for _ in range(RNG.randrange(1, 4))) for _ in range(words))


BASE = prose(60)
WORDS = BASE.split()
ODD = [
    (1, BASE, "en", "a"), (2, BASE, "en", "a"), (2, BASE, "en", "a"), (3, None, None, None), (4, "", "en", None), (None, prose(30), "fr", "b"),
    (5, " ".join([*WORDS[:20], "zzz", *WORDS[21:]]), "en", "c"), (6, "\n \n", "en", "c"), (7, prose(40) + "\n" + BASE + "\n\n" + BASE, "de", "c"),
    (8, "x" * 70_000 + " <|endoftext|> it's", "en", "a"), (9, "ÀÉ " * 30_000, "fr", "b"), (10, "Released under the MIT License.", "en", "a"),
    (11, " ".join(WORDS[:30] + ["one"] + WORDS[30:]), "en", "a"), (12, "$$$ ### " * 40, "en", "b"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, a, s, 0, "r", "k", "n") for i, t, a, s in ODD], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return (text or "").encode().split()


def test_tokenizers_agree(docs):
    from tokenizers import Tokenizer

    for name, make in (("word_bpe_49k.json", token_counts.count_tokens), ("byte_bpe_50k.json", bpe_codec.encode_documents)):
        lib = Tokenizer.from_file(vocabulary(name))
        for rows in (make(docs, vocabulary(name)).collect(),):
            want = Counter((i, len(lib.encode(t or "", add_special_tokens=False).ids)) for i, t, _, _ in ODD)
            assert Counter((r["doc_id"], r["n_tokens"]) for r in rows) == want
    got = {r["doc_id"]: r for r in bpe_codec.encode_documents(docs, vocabulary("byte_bpe_50k.json"), with_ids=True).collect()}
    for i, t, _, _ in ODD:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        assert got[i]["token_ids"] == ids
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_streams_and_state_maps_agree_for_any_cut():
    codec, counter = bpe_codec.Codec(vocabulary("byte_bpe_50k.json")), token_counts.Counter(vocabulary("word_bpe_49k.json"))
    for _ in range(40):
        text = "".join(RNG.choice("ab 'sre\n1.é ") for _ in range(RNG.randrange(1, 300))) + "ab" * RNG.choice([0, 90])
        want = np.concatenate([np.zeros(0), *codec.encode(text)]).tolist()
        for piece in (5, 37):
            assert np.concatenate([np.zeros(0), *codec.encode(text, piece)]).tolist() == want
            maps = [counter.state_map(text[i : i + piece]) for i in range(0, len(text), piece)]
            assert counter.close(counter.scan(maps)[-1]) == counter.count(text)
        assert "".join(codec.decode(codec.encode(text))) == text


def test_text_without_gaps_is_composed_in_linear_space():
    counter = token_counts.Counter(vocabulary("word_bpe_49k.json"))
    parts = ["x" * 4096] * 500
    maps = [counter.state_map(x) for x in parts]
    tracemalloc.start()
    whole = counter.scan(maps)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert whole[-1][1] == "".join(parts) and peak < 5 * len(whole[-1][1])


def test_long_documents_are_dealt_over_tasks_that_share_a_counter(spark):
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    texts = {i: f"{prose(20 + i)} {'z' * (50 * (i % 3))}" for i in range(40)}
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    rows = token_counts.count_tokens(docs, path, chunk=30).withColumn("part", F.spark_partition_id()).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == {i: len(lib.encode(t, add_special_tokens=False).ids) for i, t in texts.items()}
    assert len({r["part"] for r in rows}) > 3  # all were in one task, which loaded the vocabulary for each document
    assert token_counts.counter(path) is token_counts.counter(path)


def test_the_transducer_counts_alike_however_small_its_table():
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    lib, counter = Tokenizer.from_file(path), token_counts.Counter(path)
    words = [prose(1) for _ in range(300)] + ["".join(RNG.choice(a) for _ in range(n)) for a in ("ab", "etaoinshr", "xQ7+/", "\u4e2d\u6587\u5b57", "\u00e9\u00df") for n in (1, 7, 90, 300, 3000)]
    want = [len(lib.encode(w, add_special_tokens=False).ids) for w in words]
    assert counter.count_all(pa.array(words, pa.large_string())).tolist() == want
    t = counter.transducer
    t.most, t.BLOCK = 500, 200
    sizes = []
    for _ in range(2):
        assert counter.count_all(pa.array(words, pa.large_string())).tolist() == want
        sizes.append(t.size)
    assert max(sizes) <= t.most + 2 * 256 and len(t.states) <= t.size + 2
    counter.merges.forget(0)
    assert not counter.merges._fits and counter.count(" ".join(words)) == sum(want)


def test_detokenize_is_the_round_trip(docs):
    back = bpe_codec.detokenize(bpe_codec.token_ids(docs.where("doc_id <> 8"), vocabulary("byte_bpe_50k.json")), vocabulary("byte_bpe_50k.json"))
    assert all(r["decoded"] == (r["text"] or "") for r in back.collect())


def test_quality_rules(docs, spark):
    rows = {r["doc_id"]: r for r in quality_rules.score_documents(docs).collect()}
    assert rows[3]["_m"]["n_words"] == 0 and rows[3]["base_failed"] and not rows[12]["kept"] and rows[1]["kept"]
    assert rows[7]["_m"]["n_dup_lines"] == 1 and rows[7]["_m"]["n_repeat_words"] == 120
    assert {r["doc_id"] for r in quality_rules.filter_documents(docs).collect()} == {i for i, r in rows.items() if r["kept"]}


def test_texts_are_measured_once_a_pass_and_in_parts(docs, monkeypatch):
    measured = docs.select("lang", "source", quality_rules.measures().alias("_m"))
    plan = quality_rules.sketches(measured)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1  # a filter on the counts would otherwise bring a second Python worker to every task
    texts = pa.array(["a b", None, "", "$ \n$ \n", "x" * 90, "\u00c9 \u00e9"])
    monkeypatch.setattr(quality_rules, "AT_ONCE", 8)
    assert [tuple(x.values()) for x in quality_rules.measured_texts(texts).to_pylist()] == [quality_rules.measure(t) for t in texts.to_pylist()]
    assert quality_rules.measured_texts(texts.slice(0, 0)).to_pylist() == []


def test_sketch_quantiles_are_near_exact(spark):
    values = [RNG.lognormvariate(0, 1) for _ in range(4000)]
    measured = spark.createDataFrame([("en", "a", (1000, int(1000 * v), 0, 0, 0, 1)) for v in values],
                                     "lang string, source string, _m struct<n_words:long,word_chars:long,n_symbols:long,n_dup_lines:long,n_repeat_words:long,n_lines:long>")
    limit = quality_rules.thresholds(measured).first()["limits"]["chars_per_word"]
    mid, high = np.quantile(values, [0.5, 0.9])
    assert limit == pytest.approx(mid + quality_rules.SPREADS * (high - mid), rel=0.06)


def test_limits_follow_the_clean_part_of_a_group(spark):
    measures = "lang string, source string, _m struct<n_words:long,word_chars:long,n_symbols:long,n_dup_lines:long,n_repeat_words:long,n_lines:long>"
    rows = []
    for bad in (0, 15, 30):
        for i in range(600):
            chars = int(400 * RNG.gauss(5, 0.2))
            rows.append((f"x{bad}", "a", (400, 400 * 15, 400, 9, 100, 10) if i % 100 < bad else (400, chars, i % 50 == 49, 0, 0, 10)))
    # far above clean values, far below the fixed cutoffs of before
    rows += [("x0", "a", (400, 400 * 9, 0, 0, 0, 10)), ("x0", "a", (400, 2000, 60, 0, 0, 10)), ("x0", "b", (400, 2000, 60, 0, 0, 10))]
    frame = spark.createDataFrame([(a, s, tuple(map(int, m))) for a, s, m in rows], measures)
    judged = quality_rules.judge(frame, quality_rules.thresholds(frame)).collect()
    assert len(judged) == len(rows)
    for r in judged:
        m = r["_m"]
        assert r["kept"] == (m["word_chars"] < 400 * 7 and m["n_symbols"] < 2 and m["n_dup_lines"] == 0), r
    limits = {r["lang"]: r["limits"] for r in quality_rules.thresholds(frame).where("source = 'a'").collect()}
    assert limits["x0"]["chars_per_word"] < 8 and limits["x30"]["chars_per_word"] < 13 and limits["x30"]["duplicate_lines"] < 0.4


def test_no_limit_above_the_language(spark):
    measures = "lang string, source string, _m struct<n_words:long,word_chars:long,n_symbols:long,n_dup_lines:long,n_repeat_words:long,n_lines:long>"
    rows = [("en", "good", (100, 500 + i % 9, 0, 0, 0, 10)) for i in range(2000)] + [("en", "junk", (100, 500, 50 + i % 50, 0, 0, 10)) for i in range(300)]
    frame = spark.createDataFrame(rows, measures)
    kept = quality_rules.judge(frame, quality_rules.thresholds(frame)).where("kept").groupBy("source").count().collect()
    assert [tuple(r) for r in kept] == [("good", 2000)]


def test_line_dedup(docs):
    rows = {r["doc_id"]: r["kept"] for r in line_dedup.line_report(docs).collect()}
    # 2, 5, 11 are within a word of line 0 of 1; 7 keeps its own first line only
    assert rows[1] == [0] and rows[2] == [] and rows[5] == [] and rows[11] == [] and rows[7] == [0] and rows[3] == [] and rows[10] == [0]
    left = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs).collect()}
    assert 2 not in left and 5 not in left and left[1] == BASE and left[3] is None and left[7].split("\n")[1:] == [""]


def test_line_dedup_against_brute_force(spark):
    base = [prose(RNG.choice([6, 7, 8, 15, 16, 17, 32, 33, 64, 65, 130])).split() for _ in range(40)]
    lines = []
    for w in base:
        lines.append(w)
        i = RNG.randrange(len(w))
        lines.append(RNG.choice([[*w[:i], "q", *w[i + 1 :]], [*w[:i], "q", *w[i:]], [*w[:i], *w[i + 1 :]], ["q", *w[1:-1], "q"]]))
    kept = {r["doc_id"] for r in line_dedup.dedup_lines(spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(lines)], "doc_id long, text string")).collect()}

    def near(a, b):
        if len(a) < line_dedup.MIN_WORDS:  # a: the later line
            return a == b
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) <= 1
        s, t = sorted((a, b), key=len)
        return len(t) - len(s) == 1 and any(t[:i] + t[i + 1 :] == s for i in range(len(t)))

    assert kept == {i for i, a in enumerate(lines) if not any(near(a, b) for b in lines[:i])}


def test_simhash(docs, spark):
    def plain(text):
        w = (text or "").encode().lower().split()
        s = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(x, 42) for x in s]
        return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))

    rows = simhash.near_duplicates(docs).collect()
    assert Counter((r["doc_id"], r["fp"] & (1 << 64) - 1) for r in rows) == Counter((i, plain(t)) for i, t, _, _ in ODD)
    assert {r["component_id"] for r in rows if r["doc_id"] in (1, 2)} == {1} and {r["component_id"] for r in rows if r["doc_id"] in (3, 4, 6)} == {3}
    kept = Counter(r["doc_id"] for r in simhash.keep_first(docs).collect())
    assert kept[1] == 1 and not kept[2] and kept[3] == 1 and kept[None] == 1


def test_simhash_links_against_brute_force(spark, monkeypatch):
    centre = RNG.getrandbits(64)
    fps = {RNG.getrandbits(64) for _ in range(300)}
    fps |= {centre ^ sum(1 << b for b in RNG.sample(range(64), RNG.randrange(4))) for _ in range(300)}
    signed = sorted(x - (1 << 64 if x >> 63 else 0) for x in fps)
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    found = {r["fp"]: r["g"] for r in simhash.groups(frame).collect()}
    root = {x: x for x in signed}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(signed):
        for y in signed[i + 1 :]:
            if ((x ^ y) & (1 << 64) - 1).bit_count() <= 2:
                a, b = sorted((top(x), top(y)))
                root[b] = a
    assert found == {x: top(x) for x in signed}


def test_mixing(docs, spark):
    rows = spark.createDataFrame([(i, prose(RNG.randrange(1, 30)), s, 0) for i, s in enumerate(["a"] * 30 + ["b"] * 300 + ["c"] * 100 + [None] * 50)], "doc_id long, text string, source string, times long")
    got = mixing.queue(rows, ["doc_id"]).toPandas()
    again = mixing.queue(rows.repartition(5), ["doc_id"]).toPandas()
    assert got.sort_values("doc_id").reset_index(drop=True).equals(again.sort_values("doc_id").reset_index(drop=True))
    assert (got["taken"] <= 3 * got["size"]).all() and got["taken"].sum() <= got["size"].sum()
    for _, g in got.groupby(["target", "source_size"]):
        assert abs(g["taken"].sum() - g["target"].iloc[0]) <= 60
    mixed = mixing.mix_documents(rows).toPandas()
    assert list(mixed.columns) == rows.columns and mixed.groupby("doc_id").size().max() <= 3
    targets = got.merge(rows.toPandas()[["doc_id", "source"]]).groupby("source", dropna=False)["target"].first()
    taken = mixed["text"].str.split().str.len().groupby(mixed["source"].fillna("-")).sum()
    assert all(abs(taken[s if isinstance(s, str) else "-"] - t) <= 60 for s, t in targets.items())
    assert mixing.queue(docs, ["doc_id"]).count() == len(ODD)


def test_embeddings(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((400, 16))
    x[200:] = x[:200] + rng.standard_normal((200, 16)) * rng.choice([0, 0.05, 0.2, 0.5], (200, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [0.0] * 16), (902, [math.nan] * 16), (903, [None] * 16), (904, x[0].tolist()), (None, x[1].tolist())]
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    good = [(i, np.array(v)) for i, v in rows if i is None or i < 900 or i == 904]
    u = np.array([v / np.linalg.norm(v) for _, v in good])
    link = (u @ u.T >= 0.95) & ~np.eye(len(u), dtype=bool)
    assert {i: int(n) for (i, _), n in zip(good, link.sum(1))} == {i: got[i]["n_links"] for i, _ in good}
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (900, 901, 902, 903)) and got[904]["component_id"] == 0


def test_elias_fano():
    values = np.unique(np.random.default_rng(2).integers(0, 1 << 40, 5000).astype("uint64"))
    s = elias_fano.Sequence(np.frombuffer(elias_fano.Sequence.pack(values), "u1"))
    words = np.array([1, 1 << 63, 0xF0F0F0F0F0F0F0F0, (1 << 64) - 1, (1 << 64) - 1], "uint64")
    assert elias_fano.nth_one(words, np.array([0, 0, 31, 0, 63])).tolist() == [0, 63, 63, 0, 63]
    assert (s.get(np.arange(len(values))) == values).all()
    ask = np.concatenate([values, values + np.uint64(1)])
    place, hit = s.successor(ask)
    assert (hit == np.isin(ask, values)).all() and (place[: len(values)] == np.arange(len(values))).all()


def test_language_model(docs, spark):
    frame = docs.select("doc_id", "text")
    training = F.crc32(F.col("doc_id").cast("string")) % 10 != 0
    got = ngram_lm.score_texts(frame, training).collect()
    counts = Counter(w for i, t, _, _ in ODD if i is not None and zlib.crc32(str(i).encode()) % 10 for w in [*(t or "").encode().lower().split(), b" "])
    n, v = sum(counts.values()), len(counts)
    want = {i: sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in [*(t or "").encode().lower().split(), b" "]) for i, t, _, _ in ODD}
    assert len(got) == len(ODD)
    for r in got:
        assert r["train_tokens"] == n and r["base_score"] == pytest.approx(want[r["doc_id"]]) and r["score"] < 0


def test_language_model_reads_batches_in_parts(spark):
    texts = pa.array(["A b c d e f", "5 6 7", "Q 1 1", "x"])
    part = ngram_lm.Batch(texts.slice(1, 2))
    assert part.doc.tolist() == [0, 0, 0, 0, 1, 1, 1, 1] and len(part.hashes) == 6
    rows = [(1, "One two " * (ngram_lm.AT_ONCE // 8)), (2, "one three"), (3, "TWO " * 5)]
    got = {r["doc_id"]: r for r in ngram_lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), F.lit(True)).collect()}
    assert {i: r["n_tokens"] for i, r in got.items()} == {i: len(t.split()) + 1 for i, t in rows}
    assert all(r["n_known"] == r["n_tokens"] and r["train_tokens"] == sum(len(t.split()) + 1 for _, t in rows) for r in got.values())


def test_language_model_keeps_bigrams_seen_once(spark):
    texts = [f"a{i} b{i} c{i}" for i in range(300)] + ["xx yy"] * 200
    frame = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    lines = [[" ", *t.split(), " "] for t in texts]
    single, double = Counter(w for x in lines for w in x[1:]), Counter(p for x in lines for p in zip(x, x[1:]))
    n, v = sum(single.values()), len(single)
    share = sum(k for (a, b), k in double.items() if (k - 1) / max(single[a] - 1, 1) > (single[b] - 1) / (n - 1)) / n
    one = lambda w: (single[w] - 0.5) / n + 0.5 * v / n / (v + 1)  # noqa: E731  (no word is seen twice)
    chance = lambda a, b: (1 - share) * one(b) + share * double[a, b] / single[a]
    assert share > 0 and sum(chance("a1", w) for w in single) == pytest.approx(1, abs=1e-3)
    for r in ngram_lm.score_texts(frame, F.lit(True)).where("doc_id < 300").collect():
        x = lines[r["doc_id"]]
        assert r["score"] == pytest.approx(sum(math.log10(chance(*p)) for p in zip(x, x[1:])), abs=1e-3)


def test_language_model_shards_get_places_not_keys(spark, monkeypatch):
    rows = [(i, f"the w{i} and the w{i % 7} of x{i % 3}") for i in range(400)] + [(7, None), (7, None), (None, "the w1")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sorted(map(tuple, ngram_lm.score_texts(frame, F.col("doc_id") > 100).collect()), key=repr)
    keyed = frame.coalesce(1).select(F.xxhash64("doc_id", "text").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    for shards in (8, 64):  # a batch's keys travel once, however many the shards
        asked = [ngram_lm._unplanes(bytes(r["data"])) for r in ngram_lm.questions(keyed, shards, np.zeros(0, "uint64")).collect()]
        assert sum(len(p) for x in asked for p in x if p.dtype == "int64") == len(rows)
    monkeypatch.setattr(ngram_lm, "SHARD_CHARS", 1000)
    parted = sorted(map(tuple, ngram_lm.score_texts(frame, F.col("doc_id") > 100).collect()), key=repr)
    assert len(whole) == len(parted) == len(rows)
    for a, b in zip(whole, parted):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4]) and a[5] == pytest.approx(b[5], abs=1e-2)


def test_language(spark):
    other = ["xu", "vy", "wo", "zzi", "qe"]
    rows = [(i, prose(40), "en") for i in range(60)] + [(100 + i, " ".join("".join(RNG.choice(other) for _ in range(3)) for _ in range(40)), "xx") for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_crf.fit(frame.where("doc_id % 4 <> 0"))
    mixed = prose(60) + "\n" + " ".join("".join(RNG.choice(other) for _ in range(3)) for _ in range(20))
    extra = spark.createDataFrame([(500, mixed, None), (501, None, None), (502, "12 !?", None), (None, "", None)], frame.schema)
    got = {r["doc_id"]: r for r in language_crf.predict(frame.where("doc_id % 4 = 0").union(extra), model).collect()}
    assert all(got[i]["lang_pred"] == a for i, _, a in rows if i % 4 == 0)
    assert got[500]["lang_pred"] == "en" and 0.6 < got[500]["score"] < 0.9
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (501, 502, None))


def test_language_learns_every_label(spark):
    make = lambda parts, n: " ".join("".join(RNG.choice(parts) for _ in range(3)) for _ in range(n))
    kinds = {"aa": ["ba", "co", "di"], "bb": ["xu", "vy", "wo"], "cc": ["zzi", "qe", "ky"]}
    rows = [(make(kinds["aa"], 30), "aa") for _ in range(300)] + [(make(kinds["bb"], 3000), "bb") for _ in range(8)]
    assert all(len(t) > language_crf.MAX_CHARS for t, a in rows if a == "bb")
    rows += [(make(kinds["cc"], 30), "cc") for _ in range(3)] * 400
    model = language_crf.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert model.langs == ["aa", "bb", "cc"]
    asked = spark.createDataFrame([(f"{a}{i}", make(x, 20)) for a, x in kinds.items() for i in range(5)], "doc_id string, text string")
    assert all(r["lang_pred"] == r["doc_id"][:2] for r in language_crf.predict(asked, model).collect())


def test_licenses(docs):
    got = {r["doc_id"]: [m["license"] for m in r["matches"]] for r in licenses.scan(docs).collect()}
    assert got[10] == ["MIT"] and not any(x for i, x in got.items() if i != 10)


HEADERS = {
    "GPL-2.0": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
                "under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.", "GNU GENERAL PUBLIC LICENSE\n Version 2, June 1991\n Copyright (C) 1989"],
    "GPL-3.0": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
                "GNU GENERAL PUBLIC LICENSE\n Version 3, 29 June 2007\n Copyright (C) 2007"],
    "LGPL": ["under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License", "GNU LESSER GENERAL PUBLIC LICENSE\n Version 3, 29 June 2007"],
    "AGPL-3.0": ["under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"],
    "Apache-2.0": ["Apache License\n Version 2.0, January 2004\n http://www.apache.org/licenses/"],
    "MPL-1.1": ["The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.mozilla.org/MPL/"],
    "MPL-2.0": ["Mozilla Public License Version 2.0\n 1. Definitions"],
    "EPL-1.0": ["All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution"],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at", "Eclipse Public License - v 2.0"],
    "Zlib": ["This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone"],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0. (See accompanying file)", "Boost Software License - Version 1.0 - August 17th, 2003"],
    "Artistic-2.0": ["you can redistribute it and/or modify it under the terms of the Artistic License 2.0."],
}


def test_canonical_license_headers(spark):
    rows = [(i, name, f"{BASE}\n{text}\n{BASE}") for i, (name, text) in enumerate((n, x) for n, texts in HEADERS.items() for x in texts)]
    got = {r["doc_id"]: sorted({m["license"] for m in r["matches"]}) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, name string, text string")).collect()}
    assert got == {i: [name] for i, name, _ in rows}


def test_notices_shorter_than_a_shingle(spark):
    frame = spark.createDataFrame([(1, f"{BASE} All Rights-Reserved. {BASE}"), (2, "all rights reserved"), (3, "rights all reserved " * 3), (4, None)], "doc_id long, text string")
    for notices in ({"X": ["all rights reserved"]}, {"X": ["all rights reserved"], **licenses.NOTICES}):
        assert {r["doc_id"]: [tuple(m) for m in r["matches"]] for r in licenses.scan(frame, notices).collect()} == {1: [("X", 1.0)], 2: [("X", 1.0)], 3: [], 4: []}


def test_empty_tables(empty, spark):
    path = vocabulary("byte_bpe_50k.json")
    none = spark.createDataFrame([], "vec_id long, embedding array<double>")
    for frame in (
        token_counts.count_tokens(empty, vocabulary("word_bpe_49k.json")), bpe_codec.encode_documents(empty, path), quality_rules.score_documents(empty),
        quality_rules.filter_documents(empty), line_dedup.line_report(empty), line_dedup.dedup_lines(empty), simhash.near_duplicates(empty), simhash.keep_first(empty),
        mixing.queue(empty, ["doc_id"]), mixing.mix_documents(empty), licenses.scan(empty), embeddings.near_duplicates(none),
        ngram_lm.score_texts(empty, F.lit(True)), language_crf.predict(empty, language_crf.fit(empty)),
    ):
        assert frame.count() == 0


def test_stages_run_and_keep_the_columns(docs, spark):
    out = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, SF_SMALL).cache()
        assert out.columns == docs.columns and out.count() > 0, name
    assert {"op%d" % n for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}


def test_line_words_and_single_word_blocks_need_no_regex_or_split(spark):
    """Words are found without a regex, and at rate 1 a block is a word: its hash needs no marks and no split."""
    lines = [(0, "a b\tc\x0bd\x0ce\rf  g "), (1, " \t\r"), (2, ""), (3, "é x y"), (4, "plain words alone")]
    df = spark.createDataFrame(lines, "id long, line string")
    words = line_dedup._words(F.col("line"))
    out = df.select("id", words.alias("words"), line_dedup._blocks(words, F.lit(1).cast("bigint")).alias("blocks"))
    hashes = df.select("id", F.transform(words, lambda w: F.xxhash64(w)).alias("blocks"))
    assert {r["id"]: r["words"] for r in out.collect()} == {i: re.findall(r"[^\x20\x09-\x0D]+", x) for i, x in lines}
    assert {r["id"]: r["blocks"] for r in out.collect()} == {r["id"]: r["blocks"] for r in hashes.collect()}
    assert "rlike" not in out._jdf.queryExecution().optimizedPlan().toString().lower()
