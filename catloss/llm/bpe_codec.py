"""Byte-level BPE encoding and decoding as streaming transducers.

The encoder takes a text in pieces of any size. It splits off words with the byte-level
pattern, holding back what a later character could still change, and merges each word
from left to right (``bpe.MergeList``): a token goes out once it is settled, which the
merge list decides within its lookahead (the longest proper beginning of a token). Words
of usual length are merged at once and remembered; a longer word goes through
``bpe.Stream`` symbol by symbol, so memory stays constant however long it is (but for runs
of white space, which are held back as a whole). The
decoder maps ids to bytes and completes characters with an incremental UTF-8 machine.

Defined cases: null and empty texts have no tokens and decode to the empty string;
repeated rows give one result row each; very long texts are read in pieces of ``PIECE``
characters; an empty table gives no rows; further columns are ignored by ``encode_documents``.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catloss.llm.bpe import MergeList, Stream, byte_symbols
from catloss.llm.common import per_process, sliced, text_or_empty

PIECE = 1 << 16
AT_ONCE = 2_000_000  # bytes of text that a task holds as words, unless one text is longer
LONG = 96  # bytes from which a word is streamed
MEMO = 500_000  # distinct words from which on a worker's memory of them starts anew

# fixed value: the byte-level split pattern of the vocabulary
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Up to here the regex module and the tokenizers library agree on every character's class.
PLAIN = re.compile("[^\x00-ԯ]")
#: Characters that the pattern looks at beyond a match's end, contractions included.
BEYOND = 3


class _Words(dict):
    """Ids of words as bytes; makes those that it lacks, and remembers them unless they are long."""

    def __init__(self, codec: Codec):
        self.codec = codec

    def __missing__(self, word: str) -> bytes:
        merges, symbols = self.codec.merges, self.codec.symbols(word)
        if len(word) > LONG:
            stream = Stream(merges)
            return self.codec._ids(stream.feed(symbols) + stream.finish())
        ids = self[word] = self.codec._ids(merges.split(symbols))
        return ids


class Codec:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        lib = Tokenizer.from_file(path)
        self.words = lib.pre_tokenizer.pre_tokenize_str
        self.special = {t.content: i for i, t in lib.get_added_tokens_decoder().items()}
        self.special_re = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.merges = MergeList.load(path)
        self.shown = dict(enumerate(byte_symbols()))
        to_byte = {c: b for b, c in self.shown.items()}
        self.bytes = {i: bytes(to_byte[c] for c in t) for t, i in self.merges.ids.items() if all(c in to_byte for c in t)}
        self.bytes |= {i: t.encode() for t, i in self.special.items()}
        self.memo = _Words(self)

    def symbols(self, text: str) -> str:
        return text.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.shown)

    def learn(self, splits: Iterable[list[str]]) -> None:
        """Merge the new distinct words of some texts' splits in sorted order, so that shared beginnings are merged once."""
        if len(self.memo) > MEMO:
            self.memo.clear()
        new: set[str] = set()
        for words in splits:
            new.update(words)
        ids = self.merges.ids
        by_symbols = {self.symbols(w): w for w in new.difference(self.memo) if len(w) <= LONG}
        for s, lasts, _ in self.merges.walk(sorted(by_symbols)):
            self.memo[by_symbols[s]] = np.array([ids[t] for t in self.merges.tokens(lasts)], "<u4").tobytes()

    def split(self, text: str) -> list[str]:
        return SPLIT.findall(text) if PLAIN.search(text) is None else [text[a:b] for a, b in self.spans(text)]

    def spans(self, text: str) -> Iterable[tuple[int, int]]:
        """Where the pattern's words begin and end; rarer scripts are split by the library itself."""
        if PLAIN.search(text) is None:
            return (m.span() for m in SPLIT.finditer(text))
        return (span for _, span in self.words(text))

    def split_batch(self, texts: list[str], piece: int = PIECE) -> list[list[str] | None]:
        """The words of each text, which are learned; None of one that is long or has special tokens."""
        plain = [len(x) <= piece and not (self.special_re and self.special_re.search(x)) for x in texts]
        splits = [self.split(x) if ok else None for x, ok in zip(texts, plain)]
        self.learn(x for x in splits if x is not None)
        return splits

    def joined(self, words: list[str]) -> np.ndarray:
        """Ids of a split text."""
        return np.frombuffer(b"".join(map(self.memo.__getitem__, words)), "<u4")

    def encode(self, text: str, piece: int = PIECE) -> Iterator[np.ndarray]:
        """Ids of the whole text, as arrays of settled ids."""
        for k, part in enumerate(self.special_re.split(text) if self.special_re else [text]):
            if k % 2:
                yield np.array([self.special[part]], "<u4")
            elif len(part) <= piece:
                yield self.joined(self.split(part))
            else:
                yield from (np.frombuffer(x, "<u4") for x in self._encode(part, piece))

    def _encode(self, text: str, piece: int) -> Iterator[bytes]:
        held, stream, kind = "", None, None
        for at in range(0, len(text), piece):
            held += text[at : at + piece]
            last = at + piece >= len(text)
            if stream is not None:  # inside a long word: it goes on as long as its kind of character does
                run = self._run(kind, held)
                if run == len(held) and not last:
                    run = max(0, run - BEYOND)
                    yield self._ids(stream.feed(self.symbols(held[:run])))
                    held = held[run:]
                    continue
                yield self._ids(stream.feed(self.symbols(held[:run])) + stream.finish())
                held, stream = held[run:], None
            done, out = 0, []
            for a, b in self.spans(held):
                if not last and b + BEYOND > len(held):
                    if b - a > LONG and (kind := self._kind(held[a:b])) is not None:
                        stream = Stream(self.merges)
                        done = max(a + 1, b - BEYOND)
                        out.append(self._ids(stream.feed(self.symbols(held[a:done]))))
                    break
                out.append(self.memo[held[a:b]])
                done = b
            held = held[done:]
            yield b"".join(out)

    @staticmethod
    def _kind(word: str) -> str | None:
        """A character of the class that a long word goes on with; None for white space, whose end depends on what follows."""
        return next((c for c, k in RUNS.items() if k.fullmatch(word.removeprefix(" "))), None)

    def _run(self, kind: str, text: str) -> int:
        """How far a word of this class goes on into ``text``; the library says so where the text has rarer scripts."""
        if PLAIN.search(text) is None:
            return RUNS[kind].match(text).end()
        return next(iter(self.words(kind + text)))[1][1] - 1

    def _ids(self, tokens: list[str]) -> bytes:
        return np.array([self.merges.ids[t] for t in tokens], "<u4").tobytes()

    def decode(self, ids: Iterable[np.ndarray]) -> Iterator[str]:
        """Text for arrays of ids, as soon as its characters are complete; broken bytes give U+FFFD."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        for part in ids:
            yield machine.decode(b"".join(map(self.bytes.__getitem__, part.tolist())))
        yield machine.decode(b"", True)


#: A character of each class of characters that words are made of, with the runs of the class.
RUNS = {"a": regex.compile(r"\p{L}*"), "1": regex.compile(r"\p{N}*"), "!": regex.compile(r"[^\s\p{L}\p{N}]*")}


def digest(codec: Codec, text: str, words: list[str] | None = None, keep: bool = False) -> tuple[list[np.ndarray], int, str, str]:
    """(ids if they are kept, their number, SHA-256 of them as little-endian 32-bit integers, SHA-256 of the decoded text), made piece by piece."""
    parts, n, ids_hash, text_hash = [], 0, hashlib.sha256(), hashlib.sha256()

    def ids():
        nonlocal n
        for part in codec.encode(text) if words is None else [codec.joined(words)]:
            n += len(part)
            ids_hash.update(part)
            if keep:
                parts.append(part)
            yield part

    for out in codec.decode(ids()):
        text_hash.update(out.encode("utf-8"))
    return parts, n, ids_hash.hexdigest(), text_hash.hexdigest()


def encode_documents(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256) for each document; with_ids adds token_ids: array<int>."""

    def run(batches):
        codec = per_process(("codec", path), lambda: Codec(path))
        for b in (part for batch in batches for part in sliced(batch, AT_ONCE)):
            texts = b.column("text").to_pylist()
            sizes, ids, digests = [], [], []
            for x, words in zip(texts, codec.split_batch(texts)):
                parts, n, *hashes = digest(codec, x, words, with_ids)
                sizes.append(n)
                digests.append(hashes)
                ids += parts
            columns = [b.column("doc_id"), pa.array(sizes, pa.int64()), *(pa.array([d[i] for d in digests], pa.string()) for i in (0, 1))]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                flat = np.concatenate([np.zeros(0, "<u4"), *ids]).astype("int32")
                columns.append(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.array(flat)))
                names.append("token_ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        run, f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>" * with_ids
    )


def token_ids(docs: DataFrame, path: str) -> DataFrame:
    """The documents with a column token_ids: array<int> (empty for null texts)."""

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = Codec(path)
        for texts in batches:
            codec.learn(codec.split(x) for x in texts if x and len(x) <= PIECE)
            yield texts.map(lambda t: np.concatenate([np.zeros(0, "<u4"), *codec.encode(t or "")]).astype("int32"))

    return docs.withColumn("token_ids", encode(text_or_empty()))


def detokenize(ids: DataFrame, path: str, column: str = "token_ids") -> DataFrame:
    """Add decoded: the text of the ids (empty for null)."""

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = Codec(path)
        for rows in batches:
            yield rows.map(lambda r: "" if r is None else "".join(codec.decode(np.asarray(r[i : i + PIECE]) for i in range(0, len(r), PIECE))))

    return ids.withColumn("decoded", decode(F.col(column)))
