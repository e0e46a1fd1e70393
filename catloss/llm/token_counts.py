"""Token counts by a compiled transducer.

Words are counted by a deterministic transducer compiled from the merge list
(``bpe.CountTransducer``), whose transitions carry emitted-token counts; a worker process
makes it once and keeps what it has compiled. It starts anew at ASCII white space, so what
a chunk of text does is told by its map: the text before the chunk's first gap (still open
to the left), the count between first and last gap, and the text after the last gap (open to
the right); a chunk without a gap is open on both sides and is its own map. Such maps compose
associatively. They are not maps between transducer states: text without gaps is put together
again and counted in one task. Texts of up to ``CHUNK`` characters are counted where they lie;
longer ones are cut into chunks that Spark spreads over the cluster, and each document's
maps are composed in one task, neighbours first, then neighbouring pairs, until one is left.
Chunks and documents are dealt over all shuffle partitions: their bytes don't tell their work.

Normalisation and the split into words are the tokenizers library's own, applied to
each distinct stretch without gaps; both leave gaps where they are.

Defined cases: null and empty texts have 0 bytes and 0 tokens; repeated rows give one
result row each; further columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catloss.llm.bpe import END, CountTransducer, MergeList, byte_symbols
from catloss.llm.common import WS, per_process, shuffle_width, sliced, text_or_empty

CHUNK = 1 << 16
AT_ONCE = 8_000_000  # bytes of text that a task holds as words, unless one text is longer
BORDERS = 250_000  # pairs of tokens from which on a worker's memory of them starts anew

# fixed value: the word pattern of the vocabulary
PLAIN_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
NOT_PLAIN = re.compile("[\n\x1c-\x1f\x85\xa0\u03a3\u0530-\U0010ffff]|<\\|")


class Counter:
    """Counts tokens of stretches of text without gaps, for a tokenizers file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        lib = Tokenizer.from_file(path)
        self.normalize = lib.normalizer.normalize_str if lib.normalizer else (lambda s: s)
        self.words = lib.pre_tokenizer.pre_tokenize_str
        special = [t.content for t in lib.get_added_tokens_decoder().values()]
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.merges = MergeList.load(path)
        self.byte = {ord(c): b for b, c in enumerate(byte_symbols())}
        self.end = END if any(ord(t[-1]) >= END for t in self.merges.ids) else 0
        self.transducer = CountTransducer(self.merges, self.end)

    def pieces(self, stretch: str) -> tuple[int, list[bytes]]:
        """(special strings, words as bytes) of a stretch."""
        parts = self.special.split(stretch) if self.special else [stretch]
        words = [w for x in parts[::2] if x for w, _ in self.words(self.normalize(x))]
        return len(parts) // 2, [w.translate(self.byte).encode("latin-1") for w in words]

    def plain(self, texts: list[str]) -> list[str]:
        """Normalised plain stretches, whose words are runs of letters, single digits and runs of others.

        Up to U+052F, Python's composition and lower case agree with the library's but for the
        final sigma, which NOT_PLAIN excludes along with white space that isn't a gap.
        """
        return unicodedata.normalize("NFC", "\n".join(texts)).lower().split("\n")

    def stretches(self, texts: list[str]) -> np.ndarray:
        """Token counts of distinct stretches, whose words run through the transducer."""
        self.merges.forget(BORDERS)
        special = np.zeros(len(texts), "int64")
        owner, words, others = [], [], []
        usual = [i for i, x in enumerate(texts) if NOT_PLAIN.search(x) is None] if self.end else []
        rest = set(range(len(texts))).difference(usual)
        for i, x in zip(usual, self.plain([texts[i] for i in usual])):
            if x.isalpha():
                owner.append(i)
                words.append(x)
            elif x:
                found = PLAIN_WORD.findall(x)
                owner += [i] * len(found)
                words += found
        for i in rest:
            special[i], found = self.pieces(texts[i])
            owner += [i] * len(found)
            others += found
        words = "".join(f"{w}\n" for w in words).encode() + b"".join(w + b"\n" for w in others)
        found = self.transducer.counts(words)
        return special + np.bincount(np.asarray(owner, "int64"), found, len(texts)).astype("int64")

    def count_all(self, texts: pa.Array) -> np.ndarray:
        """Token counts of texts: each distinct stretch of the batch is counted once."""
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        known = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        each = np.append(self.stretches(known), 0)  # the last for the empty strings at a text's ends
        each[[i for i, w in enumerate(known) if not w]] = 0
        total = np.concatenate([[0], np.cumsum(each[words.indices.to_numpy(zero_copy_only=False)])]).astype("int64")
        ends = split.offsets.to_numpy()
        ends = ends - ends[0]
        return total[ends[1:]] - total[ends[:-1]]

    def count(self, text: str) -> int:
        return int(self.count_all(pa.array([text], pa.large_string()))[0])

    def state_map(self, chunk: str) -> tuple[bool, str, int, str]:
        """(open on both sides, head, tokens between the gaps, tail)."""
        cut = chunk.strip(WS)
        first = min((i for i in map(chunk.find, WS) if i >= 0), default=-1)
        if first < 0:
            return (True, chunk, 0, "")
        last = max(map(chunk.rfind, WS))
        inner = chunk[first : last + 1] if cut else ""
        return (False, chunk[:first], self.count(inner), chunk[last + 1 :])

    def compose(self, a: tuple, b: tuple) -> tuple:
        if a[0] and b[0]:
            return (True, a[1] + b[1], 0, "")
        if a[0]:
            return (False, a[1] + b[1], b[2], b[3])
        if b[0]:
            return (False, a[1], a[2], a[3] + b[1])
        return (False, a[1], a[2] + self.count(a[3] + b[1]) + b[2], b[3])

    def close(self, m: tuple) -> int:
        return self.count(m[1]) + m[2] + self.count(m[3])

    def scan(self, maps: list[tuple]) -> list[tuple]:
        """The composition of all maps as the only entry, in a logarithmic number of rounds that keep no prefixes."""
        while len(maps) > 1:
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps


def counter(path: str) -> Counter:
    """The worker process's counter, made once: loading it takes longer than most tasks' chunks and documents."""
    return per_process(("token_counts", path), lambda: Counter(path))


def count_tokens(docs: DataFrame, path: str, chunk: int = CHUNK) -> DataFrame:
    """Rows (doc_id, n_bytes, n_tokens) for each document."""
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {id_type}, n_bytes long, n_tokens long"

    def short(batches):
        c = counter(path)
        for b in (part for batch in batches for part in sliced(batch, AT_ONCE)):
            text = b.column("text").cast(pa.large_string())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pc.binary_length(text), pa.array(c.count_all(text))], ["doc_id", "n_bytes", "n_tokens"])
            pa.default_memory_pool().release_unused()

    def chunks(batches):
        for pdf in batches:
            for key, n, bytes_, text in zip(pdf["key"], pdf["copies"], pdf["n_bytes"], pdf["text"]):
                parts = [text[i : i + chunk] for i in range(0, len(text), chunk)]
                for s in range(0, len(parts), 64):
                    k = range(s, min(s + 64, len(parts)))
                    yield pd.DataFrame({"key": key, "copies": n, "n_bytes": bytes_, "k": list(k), "text": [parts[i] for i in k]})

    def maps(batches):
        for pdf in batches:
            m = [counter(path).state_map(x) for x in pdf["text"]]
            yield pdf.drop(columns="text").assign(**{n: [x[i] for x in m] for i, n in enumerate(("open", "head", "n", "tail"))})

    def compose(pdf):
        c = counter(path)
        pdf = pdf.sort_values("k")
        whole = c.scan(list(zip(pdf["open"], pdf["head"], pdf["n"], pdf["tail"])))[-1]
        return pd.DataFrame({"key": pdf["key"].iloc[:1].values, "copies": pdf["copies"].iloc[:1].values, "n_bytes": pdf["n_bytes"].iloc[:1].values, "n_tokens": [c.close(whole)]})

    here = texts.where(F.length("text") <= chunk).mapInArrow(short, out)
    # long texts: one row for equal rows, which the last step gives back
    long = texts.where(F.length("text") > chunk).groupBy("doc_id", "text").agg(F.count("*").alias("copies"))
    long = long.select("doc_id", F.sha2("text", 256).alias("hash"), "copies", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    long = long.withColumn("key", F.struct("doc_id", "hash")).select(F.to_json("key", {"ignoreNullFields": "false"}).alias("key"), "copies", "n_bytes", "text")
    cut = long.mapInPandas(chunks, "key string, copies long, n_bytes long, k int, text string")
    width = shuffle_width(docs.sparkSession)  # named, or AQE puts small rows with much work into one task
    spread = cut.repartition(width, "key", "k").mapInPandas(maps, "key string, copies long, n_bytes long, k int, open boolean, head string, n long, tail string")
    done = spread.repartition(width, "key").groupBy("key").applyInPandas(compose, "key string, copies long, n_bytes long, n_tokens long")
    back = done.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return here.union(back.select(F.from_json("key", f"doc_id {id_type}")["doc_id"].alias("doc_id"), "n_bytes", "n_tokens"))
