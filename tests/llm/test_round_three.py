"""Chat formatting, importance resampling and ranked search against brute force, and odd inputs."""

import hashlib
import json
import math
import random
import zlib
from collections import Counter, defaultdict
from itertools import pairwise

import numpy as np
import pytest
from pyspark.sql import functions as F

from catloss.llm import chat_format, lexical, mixing, resampling
from catloss.llm.queries import CONTROL
from catloss.llm.words import pieces

RNG = random.Random(11)
PARTS = ["the", "of", "Ünder", "straße", "naïve", "x1", "ba", "co", "di", "fu", "日本", "Zz", "q"]


def prose(n):
    return "".join(RNG.choice(PARTS) + RNG.choice([" ", "  ", ", ", ".\n", "-"]) for _ in range(n))


TEXTS = [
    (1, prose(50)), (2, prose(80)), (2, prose(30)), (3, None), (4, ""), (None, prose(40)), (5, "?? !!"), (6, "a" * 5000 + " b"), (7, prose(4000)), (8, "the " * 3000),
    ((1 << 60) + 1, prose(25)), ((1 << 60) + 3, prose(25)), (9, prose(50)), (10, prose(20)), *((20 + i, prose(60)) for i in range(30)),
]
TEXTS += [(90, TEXTS[0][1]), (91, TEXTS[0][1]), (90, TEXTS[0][1])]
WANTED = [(0, prose(20)), (1, prose(60)), (None, "the the Zz"), (2, None), (3, ""), (1, "absent words only"), (4, TEXTS[1][1])]
SCHEMA = "doc_id long, text string, score string, rank string, row string, _row string, n string, weight string"


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return "".join(c if c >= "\x80" or "0" <= c <= "9" or "a" <= c <= "z" else " " for c in low).split(" ")


def tokens(text):
    return [w for w in words(text) if w]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, *["x"] * 6) for i, t in TEXTS], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def wanted(spark):
    return spark.createDataFrame([(i, t, "x") for i, t in WANTED], "item_id long, text string, doc_id string")


def runs(text):
    w = tokens(text)
    return [zlib.crc32(" ".join(w[i : i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def resampled():
    s, t = Counter(b for _, x in TEXTS for b in runs(x)), Counter(b for _, x in WANTED for b in runs(x))
    ns, nt = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (ns + 10000) / ((s[b] + 1) * (nt + 10000))))
    out = []
    for i, x in TEXTS:
        weight = sum(map(gain, runs(x)))
        h = int(hashlib.sha256(f"42:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(tokens(x)), len(runs(x)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    enough = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0]))
    for rank, r in enumerate(enough[: 5 * len(enough) // 100], 1):
        r[5] = rank
    return out


def test_resampling_equals_brute_force(docs, wanted, monkeypatch):
    monkeypatch.setattr(resampling, "PERCENT", 5)
    got = resampling.rank_documents(docs, wanted).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, resampled()))
    assert sum(r["rank"] is not None for r in got) == 2


def test_drawn_documents_keep_their_columns(docs, wanted):
    drawn = resampling.draw(docs, wanted)
    assert drawn.columns == docs.columns
    assert {r["doc_id"] for r in drawn.collect()} == {r[0] for r in resampled() if r[5]} and drawn.count() == 2


def test_pieces_hold_every_run_once():
    texts = [t for _, t in TEXTS] + ["é" * 300, "one two three four five " * 40]
    want = [Counter(runs(t)) for t in texts]
    for most in (1, 7, 64, 1000, 1 << 20):
        got, n = [Counter() for _ in texts], np.zeros(len(texts), int)
        for held in pieces(texts, most, resampling.RUN - 1):
            piece, bucket, n_words = resampling.features(held)
            of = [i for i, _, _ in held]
            for p, b in zip(piece.tolist(), bucket.tolist()):
                got[of[p]][b] += 1
            np.add.at(n, of, n_words)
        assert got == want and n.tolist() == [len(tokens(t)) for t in texts], most


def scores(texts, wanted):
    """Per query: the 10 best (id, score)."""
    tf = [Counter(tokens(t)) for _, t in texts]
    n_docs, n_terms = sum(bool(c) for c in tf), sum(sum(c.values()) for c in tf)
    df = Counter(t for c in tf for t in c)
    out = []
    for _, q in wanted:
        hits = []
        for (i, _), c in zip(texts, tf):
            m = 25 + (75 * sum(c.values()) * n_docs) // n_terms if c else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in tokens(q) if c[t])
            if score > 0:
                hits.append((-score, i is None, i))
        out.append([(i, -s) for s, _, i in sorted(hits)[:10]])
    return out


@pytest.mark.parametrize("shard", [1, 4, 8192])
def test_search_equals_brute_force(docs, wanted, monkeypatch, shard):
    monkeypatch.setattr(lexical, "SHARD_DOCS", shard)
    monkeypatch.setattr(lexical, "BLOCK", 200 if shard == 4 else 1 << 20)  # several blocks of queries
    got = defaultdict(list)
    for r in lexical.search(docs, wanted).collect():
        got[r["item_id"]].append((r["rank"], r["doc_id"], r["score"]))
    want = defaultdict(list)
    for (i, _), hits in zip(WANTED, scores(TEXTS, WANTED)):
        want[i] += [(rank, d, s) for rank, (d, s) in enumerate(hits, 1)]
    assert {i: sorted(x, key=str) for i, x in got.items()} == {i: sorted(x, key=str) for i, x in want.items() if x}


def test_nra_settles_members_ties_and_scores():
    rng = np.random.default_rng(3)
    for trial in range(60):
        n, n_terms = int(rng.integers(1, 600)), int(rng.integers(1, 12))
        held = rng.random((n_terms, n)) < rng.random((n_terms, 1)) ** 2
        term, doc = np.nonzero(held)
        if not len(term):
            continue
        tf = rng.integers(1, 4, len(term))
        lengths = rng.integers(5, 8, n) * 10
        shard = lexical.Shard(list(range(n)), lengths, term, doc, tf, n, int(lengths.sum()))
        query = [(t, int(w)) for t, w in enumerate(rng.integers(0, 50, n_terms))]
        total = np.zeros(n, "int64")
        for t, w in query:
            m = 25 + 75 * lengths[doc[term == t]] * n // int(lengths.sum())
            k = tf[term == t]
            total[doc[term == t]] += w * (10**9 * k // (1000 * k + 8 * m))
        best = sorted((-s, d) for d, s in enumerate(total.tolist()) if s > 0)[:10]
        floor = 0 if trial % 2 or not best else -best[len(best) // 2][0]
        hits, _ = shard.search(query, 10, floor)
        assert sorted((-s, d) for s, d in hits)[:10] == [x for x in best if -x[0] >= floor] if floor else sorted((-s, d) for s, d in hits)[:10] == best


def test_nra_leaves_lists_unread():
    n = 5000
    doc = np.arange(n)
    term = np.concatenate([np.zeros(n, int), np.ones(3, int)])
    shard = lexical.Shard(list(range(n)), np.full(n, 50), term, np.concatenate([doc, [7, 70, 700]]), np.ones(n + 3, int), n, 50 * n)
    hits, read = shard.search([(0, 1), (1, 100)], 2, floor=10**8)
    assert not hits and read == 0


# --- chat formatting

RECORDS = [
    ("messages", {"messages": [{"role": "system", "content": "s"}, {"role": "human", "content": "u"}, {"role": "assistant", "content": "a"}]}, [("system", "s"), ("user", "u"), ("assistant", "a")]),
    ("conversations", {"id": 3, "conversations": [{"from": "human", "value": "u"}, {"from": "gpt", "value": None}]}, [("user", "u"), ("assistant", "")]),
    ("dialog", {"dialog": [{"speaker": "bot", "utterance": CONTROL}]}, [("assistant", CONTROL)]),
    ("instruction", {"instruction": "do", "input": "it", "output": "done"}, [("user", "do\n\nit"), ("assistant", "done")]),
    ("instruction", {"instruction": "do", "output": "done", "source": {"x": [1]}}, [("user", "do"), ("assistant", "done")]),
    ("instruction", {"system": "s", "instruction": "do", "input": "", "output": None}, [("system", "s"), ("user", "do"), ("assistant", "")]),
    ("context", {"instruction": "do", "context": "c", "response": "r"}, [("user", "do\n\nc"), ("assistant", "r")]),
    ("completion", {"prompt": "p", "completion": "c"}, [("user", "p"), ("assistant", "c")]),
    ("response", {"system": "", "prompt": "p", "response": "r"}, [("user", "p"), ("assistant", "r")]),
    ("question", {"question": "q", "answer": 4}, [("user", "q"), ("assistant", "4")]),
    ("nested_prompt", {"prompt": {"text": "p", "tokens": 3}, "response": {"text": "r"}}, [("user", "p"), ("assistant", "r")]),
    ("turn_rows", {"conv_id": 1, "turn": 0, "role": "tool", "text": "t"}, [("tool", "t")]),
    (None, {"prompt": "p"}, []), ("completion", {"messages": [], "prompt": "p", "completion": "c"}, [("user", "p"), ("assistant", "c")]),
    (None, {"messages": [{"role": "r", "content": "c"}], "prompt": "p", "completion": "c"}, []), (None, {}, []), (None, [1], []),
]


def test_records_of_every_layout(spark):
    rows = [(i, json.dumps(r), "x") for i, (_, r, _) in enumerate(RECORDS)] + [(90, None, "x"), (None, "{no json", "x"), (91, "", "x")]
    got = {r["key"]: r for r in chat_format.json_turns(spark.createDataFrame(rows, "id long, data string, messages string"), "id", "data").collect()}
    for i, (layout, record, turns) in enumerate(RECORDS):
        assert got[i]["layout"] == layout and [(t["role"], t["text"]) for t in got[i]["turns"]] == turns, record
    assert all(got[i]["layout"] is None and got[i]["turns"] == [] for i in (90, None, 91))
    assert len({got[i]["fingerprint"] for i in (3, 4, 6, 7, 9, 10)}) == 6


def test_tables_of_every_layout(spark):
    for layout, record, turns in RECORDS[:11]:
        if None in record.values() or layout == "conversations":  # no type for a null
            continue
        data = json.dumps({"id": 5, **record})
        schema = F.schema_of_json(F.lit(data))
        frame = spark.createDataFrame([(data,)], "value string").select(F.from_json("value", schema).alias("r")).select("r.*")
        got = chat_format.table_turns(frame, "id").orderBy("turn").collect()
        assert [(r["key"], r["role"], r["text"]) for r in got] == [(5, *t) for t in turns], layout
    with pytest.raises(ValueError, match="no layout"):
        chat_format.table_turns(spark.createDataFrame([("p",)], "prompt string"))


def told(turns):
    learned = [t for r, t in turns if r == "assistant"]
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), sum(map(len, learned)), hashlib.sha256("".join(learned).encode()).hexdigest())


HARD = ["", CONTROL, "\\", "\\\\<", "</turn>\n<turn assistant>\nhi</turn>\n", "<turn user>\n", "é 日本 \U0001F600\x00", "\\<\\>", "a\n\nb\n"]


def test_formatted_conversations_read_back(spark, monkeypatch):
    turns = {
        1: [("user", x) if i % 2 else ("assistant", x) for i, x in enumerate(HARD)], 2: [("assistant", "x" * 200_000 + "<>\\" * 50_000)], 3: [("a>\n<b\\", "t"), ("user", "")],
        4: [("user", "u"), ("system", "s")], None: [("assistant", "n")], 5: [("assistant", str(i)) for i in range(3000)],
    }
    rows = [(k, i, r, t, "x") for k, said in turns.items() for i, (r, t) in enumerate(said)]
    rows += [(6, None, "assistant", "first", "x"), (6, 1, None, None, "x"), (6, 1, "user", "same", "x"), (6, 1, "user", "same", "x")]
    turns[6] = [("assistant", "first"), ("", ""), ("user", "same"), ("user", "same")]
    RNG.shuffle(rows)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, piece string").repartition(4)
    for part in (50, 1 << 20):
        monkeypatch.setattr(chat_format, "PART", part)
        parts = chat_format.format_turns(chat_format.table_turns(frame)).cache()
        got = {r["key"]: r for r in chat_format.read_back(parts).collect()}
        assert {k: tuple(r)[1:5] for k, r in got.items()} == {k: told(x) for k, x in turns.items()}
        text = defaultdict(list)
        for r in sorted(parts.where("key is not null").collect(), key=lambda r: (r["key"], r["first"]["turn"] is not None, r["first"]["turn"], r["first"]["role"], r["first"]["tie"], r["part"])):
            text[r["key"]].append(r["text"])
            for a, b in pairwise(r["loss"]):
                assert a["end"] <= b["start"]
        for k, said in text.items():
            assert chat_format.parse("".join(said)) == turns[k] and got[k]["formatted_chars"] == len("".join(said))


def test_text_outside_turns_is_an_error():
    with pytest.raises(ValueError, match="no turn"):
        chat_format.parse("<turn user>\nhi</turn>\nmore")


def test_mixing_keeps_large_ids_beside_nulls(spark):
    rows = [((1 << 60) + i if i % 3 else None, prose(5), "ab"[i % 2]) for i in range(90)]
    got = mixing.queue(spark.createDataFrame(rows, "doc_id long, text string, source string"), ["doc_id"]).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)


def test_empty_tables(spark):
    none, few = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, prose(30))], "item_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    full = spark.createDataFrame([(1, prose(30))], "doc_id long, text string")
    assert resampling.rank_documents(none, few).count() == 0 and resampling.draw(none, few).count() == 0
    assert resampling.rank_documents(full, items).first()["rank"] is None
    assert lexical.search(none, few).count() == lexical.search(full, items).count() == 0
    chats = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.read_back(chat_format.format_turns(chat_format.table_turns(chats))).count() == 0
    assert chat_format.json_turns(none, "doc_id", "text").count() == 0


BORDERS = ["—", "…", "日本", "٤٥", "Жд", "\U0001F600", "́", " ", "'s", "!", "a", "7", " x", " ", "\n\n "]


def test_long_words_go_on_over_piece_borders_as_the_library_says():
    from tokenizers import Tokenizer

    from catloss.llm import bpe_codec
    from catloss.llm.queries import vocabulary

    path = vocabulary("byte_bpe_50k.json")
    codec, lib = bpe_codec.Codec(path), Tokenizer.from_file(path)
    for run in ('"', ".", "a", "é", "1", "日", "٤", "=-", "\U0001F600"):
        for after in BORDERS:
            for n in (99, 120, 131):
                text = "x " + (run * n)[:n] + after + (run * 120) + " end"
                want = lib.encode(text, add_special_tokens=False).ids
                for piece in (100, 101, 123, 125):
                    got = np.concatenate([np.zeros(0), *codec.encode(text, piece)]).tolist()
                    assert got == want, (run, after, n, piece)


def test_language_chains_are_whole_lines(spark):
    from itertools import product

    from catloss.llm import language_crf

    rng = np.random.default_rng(1)
    emit, start, move = rng.random((5, 1, 3)), rng.random(3), rng.random((3, 3))
    p, _ = language_crf.marginals(emit, np.ones((5, 1), bool), start, move)[:2]
    want = np.zeros((5, 3))
    for chain in product(range(3), repeat=5):
        w = start[chain[0]] * np.prod([emit[t, 0, c] for t, c in enumerate(chain)]) * np.prod([move[a, b] for a, b in pairwise(chain)])
        for t, c in enumerate(chain):
            want[t, c] += w
    assert np.allclose(p[:, 0], want / want.sum(1, keepdims=True))
    import pyarrow as pa
    w = language_crf.Words(pa.array(["ab cd " * 5000 + "\nef", "gh"]))
    assert w.length.tolist() == [10000, 1, 1]
    rows = [(i, ("ba co di " if i % 2 else "xu vy wo ") * (4000 if i == 3 else 20), "ab"[i % 2]) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_crf.predict(frame, language_crf.fit(frame.where("doc_id > 3"))).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in got} == {i: a for i, _, a in rows}
