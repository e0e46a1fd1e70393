"""Language identification of code-switched text by a linear-chain conditional random field.

Every word with a letter gets a language by forward-backward over its line's chain. A
word's features are its character n-grams of length 2 and 3 with the word's borders, its
affixes (border n-grams of length 4) and whether it is in a language's lexicon; weights
of n-grams live in ``SLOTS`` hashed slots. Transitions between languages are learned. A
document's language is the one with the highest mean word probability, which is its score.

The model is fitted on the driver from a sample bounded by its parameters: up to
``PER_LANGUAGE`` distinct labelled texts of each language, chosen by hash; of a text of more
than ``MAX_CHARS`` characters it sees a window of that size, placed by hash. Documents carry one label but switch languages, so words are first
fitted independently, then relabelled by smoothing along the chain, and the chain's
weights and transitions are fitted to that. Prediction reads whole texts of all rows; a
chain is a line, however long.

Defined cases: a null text and one without letters is ``und`` with score 0, as is any
text if there is nothing to learn from; repeated rows are predicted alike; doc_id may be
null; other columns are not read by predictions; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catloss.llm.common import GAP, WORD, maybe_broadcast, sliced, text_or_empty

PER_LANGUAGE = 250
MAX_CHARS = 10_000
LEXICON = 300  # words per language
SLOTS = 1 << 16
SAMPLE = 4000  # labelled texts of all languages together, but one of each
AT_ONCE = 2_000_000  # bytes of text that a task labels at a time, unless one text is longer
CELLS = 400_000  # words in a padded block
STAY = 0.9  # of the smoothing that relabels words
ROUNDS = (25, 12)  # of fitting words, then chains
LINE = "\x00"


class Words:
    """Distinct words of some texts, the texts' words as indices, and where chains and texts begin."""

    def __init__(self, texts: pa.Array):
        marked = pc.replace_substring(texts.cast(pa.large_string()), "\n", f" {LINE} ")
        split = pc.ascii_split_whitespace(marked)
        words = split.flatten().dictionary_encode()
        self.known = words.dictionary.to_pylist()
        ids = words.indices.to_numpy(zero_copy_only=False).astype("int64")
        ends = split.offsets.to_numpy() - split.offsets[0].as_py()
        doc = np.repeat(np.arange(len(texts)), np.diff(ends))
        lower = "\n".join(self.known).lower() if self.known else ""
        if lower.count("\n") != max(0, len(self.known) - 1):
            lower = "\n".join(w.lower().replace("\n", "") for w in self.known)
        self.lower = lower.split("\n") if self.known else []
        self.points = np.frombuffer(f"\n{lower}\n".encode("utf-32-le", "surrogatepass"), "<u4").astype("int64")
        starts = np.flatnonzero(self.points == 10)
        self.starts, self.sizes = starts[:-1], np.diff(starts)
        letters = np.logical_or.reduceat(ALPHA[self.points], self.starts) if self.known else np.zeros(0, bool)
        brk = np.array([w == LINE for w in self.known], bool)
        line = np.cumsum(brk[ids]) if len(ids) else np.zeros(0, "int64")
        use = letters[ids] if len(ids) else np.zeros(0, bool)
        self.ids, self.doc, line = ids[use], doc[use], line[use]
        n = len(self.ids)
        new = np.ones(n, bool)
        new[1:] = (self.doc[1:] != self.doc[:-1]) | (line[1:] != line[:-1])
        begin = np.flatnonzero(new)
        length = np.diff(np.append(begin, n))
        self.begin, self.length = begin, length

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """(slots, word of each): n-grams and affixes of the distinct words."""
        c = self.points
        word = np.repeat(np.arange(len(self.known)), self.sizes)
        border = c == 10
        out, owner = [], []
        for n in (2, 3, 4):
            m = len(c) - n + 1
            if m <= 0 or not self.known:
                continue
            h = np.full(m, n, "uint64")
            ok = np.ones(m, bool)
            for k in range(n):
                h = (h * np.uint64(0x9E3779B97F4A7C15)) ^ c[k : k + m].astype("uint64") * np.uint64(0xBF58476D1CE4E5B9)
                if 0 < k < n - 1:
                    ok &= ~border[k : k + m]
            if n == 4:
                ok &= border[:m] | border[n - 1 : n - 1 + m]
            at = np.flatnonzero(ok)
            out.append((h[at] >> np.uint64(40)) % np.uint64(SLOTS))
            owner.append(word[np.minimum(at, len(word) - 1)])
        if not out:
            return np.zeros(0, "int64"), np.zeros(0, "int64")
        return np.concatenate(out).astype("int64"), np.concatenate(owner)

    def blocks(self):
        """Chains of similar length, padded: (positions [T, B], mask [T, B])."""
        order = np.argsort(self.length, kind="stable")
        at = 0
        while at < len(order):
            # the longest chain of the block is its last
            low, high = at + 1, len(order)
            while low < high:
                mid = (low + high + 1) // 2
                if self.length[order[mid - 1]] * (mid - at) <= CELLS:
                    low = mid
                else:
                    high = mid - 1
            take = order[at:low]
            t = np.arange(self.length[take].max())[:, None]
            mask = t < self.length[take][None, :]
            yield np.where(mask, self.begin[take][None, :] + t, 0), mask
            at = low


ALPHA = np.array([chr(i).isalpha() for i in range(0x110000)])


def marginals(emit: np.ndarray, mask: np.ndarray, start: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward: word probabilities [T, B, L], and expected transitions [L, L]. emit, start and move are exponentials."""
    steps, _, size = emit.shape
    emit = np.where(mask[:, :, None], emit, 1.0 / size)
    a = np.empty_like(emit)
    x = emit[0] * start
    a[0] = x / x.sum(1, keepdims=True)
    for t in range(1, steps):
        x = (a[t - 1] @ move) * emit[t]
        a[t] = x / x.sum(1, keepdims=True)
    b = np.ones_like(emit[0])
    out = np.empty_like(a)
    out[-1] = a[-1]
    pairs = np.zeros((size, size))
    for t in range(steps - 1, 0, -1):
        ends = mask[t][:, None]
        y = emit[t] * b
        both = a[t - 1][:, :, None] * move[None] * y[:, None, :]
        z = both.sum((1, 2))
        pairs += (both * (mask[t] / z)[:, None, None]).sum(0)
        x = y @ move.T
        b = np.where(ends, x / x.sum(1, keepdims=True), 1.0)
        x = a[t - 1] * b
        out[t - 1] = x / x.sum(1, keepdims=True)
    return out, pairs


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


class Model:
    def __init__(self, langs: list[str], lexicon: dict[str, int]):
        size = len(langs)
        self.langs, self.lexicon = langs, lexicon
        self.weights = np.zeros((SLOTS + size, size), "float32")
        self.start, self.move = np.zeros(size), np.zeros((size, size))

    def slots(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        slot, owner = words.features()
        member = [(i, self.lexicon[w]) for i, w in enumerate(words.lower) if w in self.lexicon]
        if member:
            i, bits = np.array(member, "int64").T
            for k in range(len(self.langs)):
                has = (bits >> k) & 1 == 1
                slot, owner = np.concatenate([slot, np.full(has.sum(), SLOTS + k)]), np.concatenate([owner, i[has]])
        return slot, owner

    def scores(self, slot: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        w = self.weights[slot]
        return np.stack([np.bincount(owner, w[:, k], n) for k in range(w.shape[1])], 1)

    def label(self, words: Words, scores: np.ndarray, start: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(probabilities of each word's languages, expected transitions, expected starts)."""
        emit = np.exp(scores - scores.max(1, keepdims=True)) + 1e-30 if len(scores) else scores
        out = np.zeros((len(words.ids), len(self.langs)))
        pairs, first = np.zeros_like(self.move), np.zeros_like(self.start)
        s, m = np.exp(start - start.max()), np.exp(move - move.max())
        for at, mask in words.blocks():
            p, moved = marginals(emit[words.ids[at]], mask, s, m)
            out[at[mask]] = p[mask]
            pairs += moved
            first += p[0].sum(0)
        return out, pairs, first

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        words, n = Words(texts), len(texts)
        if not len(words.ids) or not self.langs:
            return ["und"] * n, np.zeros(n)
        p, _, _ = self.label(words, self.scores(*self.slots(words), len(words.known)), self.start, self.move)
        total = np.stack([np.bincount(words.doc, p[:, k], n) for k in range(p.shape[1])], 1)
        count = np.bincount(words.doc, minlength=n)
        best = total.argmax(1)
        score = np.where(count > 0, total[np.arange(n), best] / np.maximum(count, 1), 0.0)
        return [self.langs[b] if c else "und" for b, c in zip(best, count)], np.clip(score, 0.0, 1.0)


def fit_model(texts: list[str], labels: list[str]) -> Model:
    """Fit on labelled texts that fit in memory."""
    langs = sorted(set(labels))
    words = Words(pa.array(texts, pa.large_string()))
    label = np.array([langs.index(x) for x in labels], "int64")[words.doc] if len(words.ids) else np.zeros(0, "int64")
    size, n = len(langs), len(words.known)
    seen = np.bincount(words.ids * size + label, minlength=n * size).reshape(n, size) if n and size else np.zeros((n, size))
    lexicon: dict[str, int] = {}
    for k in range(size):
        for i in np.argsort(-seen[:, k], kind="stable")[:LEXICON]:
            if seen[i, k] > 1:
                lexicon[words.lower[i]] = lexicon.get(words.lower[i], 0) | 1 << k
    model = Model(langs, lexicon)
    if size < 2 or not len(words.ids):
        return model
    slot, owner = model.slots(words)
    speed = np.full_like(model.weights, 1e-2)

    def step(wanted: np.ndarray, got: np.ndarray) -> None:
        """Move the weights by the difference of wanted and expected label counts of the distinct words."""
        d = ((wanted - got) / len(words.ids))[owner]
        for k in range(size):
            g = np.bincount(slot, d[:, k], SLOTS + size).astype("float32") * 1000
            speed[:, k] += g * g
            model.weights[:, k] += 0.5 * g / np.sqrt(speed[:, k])

    for _ in range(ROUNDS[0]):
        step(seen, _softmax(model.scores(slot, owner, n)) * seen.sum(1, keepdims=True))
    smooth = np.log(np.where(np.eye(size) > 0, STAY, (1 - STAY) / (size - 1)))
    p, _, _ = model.label(words, model.scores(slot, owner, n), np.zeros(size), smooth)
    p[np.arange(len(label)), label] += 0.2  # a document's label wins where its words say little
    own = p.argmax(1)
    wanted = np.bincount(words.ids * size + own, minlength=n * size).reshape(n, size).astype("float64")
    inner = np.ones(len(own), bool)
    inner[words.begin] = False
    to = np.flatnonzero(inner)
    moves = np.bincount(own[to - 1] * size + own[to], minlength=size * size).reshape(size, size) + 0.5
    model.move = np.log(moves / moves.sum(1, keepdims=True))
    model.start = np.log((np.bincount(own[words.begin], minlength=size) + 0.5) / (len(words.begin) + 0.5 * size))
    for _ in range(ROUNDS[1]):
        p, pairs, first = model.label(words, model.scores(slot, owner, n), model.start, model.move)
        got = np.stack([np.bincount(words.ids, p[:, k], n) for k in range(size)], 1)
        step(wanted, got)
        model.move += 0.5 * (moves - pairs) / max(1.0, pairs.sum()) * size
        model.start += 0.5 * (np.bincount(own[words.begin], minlength=size) - first) / max(1, len(words.begin))
    return model


def fit(labelled: DataFrame) -> Model:
    """Fit from rows (text, lang), on a bounded sample of each language's distinct texts, chosen by hash."""
    text = F.col("text").cast("string")
    rows = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select(text.alias("text"), "lang", F.xxhash64(text).alias("h"))
    pairs = rows.select("lang", "h").distinct()
    counts = {r["lang"]: r["n"] for r in pairs.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    if not counts:
        return Model([], {})
    most = max(1, min(PER_LANGUAGE, SAMPLE // len(counts)))
    # twice as many as wanted by a threshold, then the first of them by hash: no window holds a whole language
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1 << 40, (2 * most << 40) // n + 1))])
    near = pairs.where(F.pmod("h", F.lit(1 << 40)) < share[F.col("lang")])
    first = Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 40)), "h")
    chosen = near.withColumn("_k", F.row_number().over(first)).where(F.col("_k") <= most).select("lang", "h")
    chosen = maybe_broadcast(chosen)
    begin = F.pmod(F.xxhash64("h"), F.length("text") - MAX_CHARS + 1).cast("int") + 1
    window = F.substring(F.col("text"), begin, F.lit(MAX_CHARS))
    for part in (f"^{WORD}(?={GAP})", f"{GAP}{WORD}$"):  # words that the window's borders may have cut
        window = F.regexp_replace(window, part, "")
    seen = F.when(F.length("text") > MAX_CHARS, window).otherwise(F.col("text"))
    sample = rows.join(chosen, ["lang", "h"]).groupBy("lang", "h").agg(F.min(seen).alias("text"))  # copies are one text
    got = sorted(sample.collect(), key=lambda r: (r["h"], r["lang"]))
    return fit_model([r["text"] for r in got], [r["lang"] for r in got])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Rows (doc_id, lang_pred, score) for each document."""

    def run(batches):
        for b in (part for batch in batches for part in sliced(batch, AT_ONCE)):
            langs, score = model.predict(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(langs, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double")
