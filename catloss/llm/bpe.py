"""Byte-pair merge lists as deterministic left-to-right automata.

For a merge list, the tokens of a word's prefix have exactly one possible last token,
and a token may follow another only if merging never joins symbols across their border.
So a word can be read from left to right: the last token of each prefix follows from the
last tokens of shorter prefixes that lie within the longest suffix that still begins some
token. That suffix is the automaton's window; its length bounds the lookahead after which
a token border is settled.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterable, Iterator, Sequence

import numpy as np


def byte_symbols() -> list[str]:
    """The character that byte-level vocabularies write for each byte: itself if printable, else the next from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


END = 0x1000  # added to a symbol's code point where it ends a word


class MergeList:
    """Tokens are strings of one-character symbols; ``end`` is the vocabulary's word-end mark, if it has one."""

    def __init__(self, model: dict):
        end = model.get("end_of_word_suffix") or ""

        def symbols(token: str) -> str:
            if end and token.endswith(end):
                token = token[: -len(end)]
                return token[:-1] + chr(ord(token[-1]) + END)
            return token

        self.ids = {symbols(t): i for t, i in model["vocab"].items()}
        self.rank: dict[tuple[str, str], int] = {}
        self.made: dict[str, tuple[int, str, str]] = {}
        for r, pair in enumerate(model["merges"]):
            a, b = map(symbols, pair if isinstance(pair, list) else pair.split(" "))
            if (a, b) not in self.rank:
                self.rank[a, b] = r
                self.made.setdefault(a + b, (r, a, b))
        self.prefixes = {t[:k] for t in self.ids for k in range(1, len(t))}
        self.lookahead = max(map(len, self.prefixes), default=0)
        self._fits: dict[tuple[str, str], bool] = {}
        self._whole: dict[str, bool] = {}
        self.ids = {t: i for t, i in self.ids.items() if self.whole(t)}

    @classmethod
    def load(cls, path: str) -> MergeList:
        with open(path, encoding="utf-8") as f:
            return cls(json.load(f)["model"])

    def forget(self, most: int) -> None:
        """Bounds the memory of borders: they are worked out anew when asked for."""
        if len(self._fits) > most:
            self._fits.clear()

    def whole(self, token: str) -> bool:
        """Whether merging the token's own symbols gives the token."""
        if token not in self._whole:
            m = self.made.get(token)
            self._whole[token] = len(token) == 1 or bool(m) and self.whole(m[1]) and self.whole(m[2]) and self._border(m[1], m[2], m[0])
        return self._whole[token]

    def fits(self, a: str, b: str) -> bool:
        """Whether tokens a and b stay apart when their symbols are merged as one word."""
        key = (a, b)
        if key not in self._fits:
            self._fits[key] = self._border(a, b, len(self.rank))
        return self._fits[key]

    def _border(self, a: str, b: str, before: int) -> bool:
        """No merge of a rank under ``before`` joins symbols across a|b. Undoes the later-made side step by step."""
        single = (-1, "", "")
        while True:
            if self.rank.get((a, b), before) < before:
                return False
            x, y = self.made.get(a, single), self.made.get(b, single)
            if x[0] < 0 and y[0] < 0:
                return True
            if x[0] > y[0]:  # while a's right part still stood alone; equal ranks merge from the left
                before, a = min(before, x[0]), x[2]
            else:
                before, b = min(before, y[0] + 1), y[1]

    def last_token(self, window: str, lasts: Sequence) -> tuple[str, int]:
        """The last token of a text that ends in ``window``, and the position at which it starts.

        lasts: the last tokens at the window's earlier positions, None at a word's start.
        All but the window's last symbol must begin a token, as any suffix that does lies in it.
        """
        for j, a in enumerate(lasts):
            t = window[j:]
            if t in self.ids and (a is None or self.fits(a, t)):
                return t, j
        raise ValueError(f"no token ends in {window!r}")

    def walk(self, words: Iterable[str]) -> Iterator[tuple[str, list, list]]:
        """For sorted words: the word, the last token at each of its positions, and the token counts there.

        Words that begin alike share the states of their common beginning. The lists are
        reused for the next word.
        """
        ids, prefixes, known = self.ids, self.prefixes, self._fits
        before, lasts, counts, lows = "", [None], [0], [0]
        for w in words:
            n = min(len(before), len(w))
            k = n if before[:n] == w[:n] else next(i for i in range(n) if before[i] != w[i])
            del lasts[k + 1 :], counts[k + 1 :], lows[k + 1 :]
            low = lows[k]
            for i in range(k + 1, len(w) + 1):
                j, t = low, w[low:i]
                if low or t not in ids:
                    while t not in ids or not j or not ((fits := known.get((lasts[j], t))) or fits is None and self.fits(lasts[j], t)):
                        j += 1
                        t = w[j:i]
                lasts.append(t)
                counts.append(counts[j] + 1)
                while low < i and w[low:i] not in prefixes:
                    low += 1
                lows.append(low)
            yield w, lasts, counts
            before = w

    @staticmethod
    def tokens(lasts: list) -> list[str]:
        """The tokens that lead to the last position of a walk."""
        out, i = [], len(lasts) - 1
        while i > 0:
            out.append(lasts[i])
            i -= len(lasts[i])
        return out[::-1]

    def split(self, word: str) -> list[str]:
        """The tokens of one word."""
        return next((self.tokens(lasts) for _, lasts, _ in self.walk([word])), [])


class Stream:
    """Reads a word symbol by symbol and hands out tokens as soon as no later symbol can change them.

    It keeps the window (at most ``lookahead`` symbols) and, for the window's positions,
    the chain of tokens that aren't common to all of them.
    """

    def __init__(self, merges: MergeList):
        self.m, self.window, self.nodes = merges, "", [(None, None, 0)]  # node: token, parent, depth
        self.sent = 0

    def feed(self, symbols: str) -> list[str]:
        out: list[str] = []
        for c in symbols:
            w = self.window + c
            t, j = self.m.last_token(w, [x[0] for x in self.nodes])
            p = self.nodes[j]
            self.nodes.append((t, p, p[2] + 1))
            keep = next((k for k in range(max(1, len(w) - self.m.lookahead), len(w)) if w[k:] in self.m.prefixes), len(w)) if w not in self.m.prefixes else 0
            self.window, self.nodes = w[keep:], self.nodes[keep:]
            if self.nodes[0][2] - self.sent > 8:
                out += self._settled()
        return out

    def _settled(self) -> list[str]:
        """Tokens of the part that all chains share; the chains are cut there."""
        level = list({id(x): x for x in self.nodes}.values())
        while len(level) > 1:
            deepest = max(x[2] for x in level)
            level = list({id(y): y for x in level for y in [x[1] if x[2] == deepest else x]}.values())
        node, out, root = level[0], [], level[0]
        while node is not None and node[2] > self.sent:
            out.append(node[0])
            node = node[1]
        self.sent = root[2]
        fresh: dict[int, tuple] = {id(root): (root[0], None, root[2])}

        def copy(x: tuple) -> tuple:
            path = []
            while id(x) not in fresh:
                path.append(x)
                x = x[1]
            for y in reversed(path):
                fresh[id(y)] = (y[0], fresh[id(y[1])], y[2])
            return fresh[id(path[0])] if path else fresh[id(x)]

        self.nodes = [copy(x) for x in self.nodes]
        return out[::-1]

    def finish(self) -> list[str]:
        node, out = self.nodes[-1], []
        while node is not None and node[2] > self.sent:
            out.append(node[0])
            node = node[1]
        return out[::-1]


class CountTransducer:
    """A lazily compiled deterministic transducer over bytes, whose transitions carry the number of tokens they emit.

    A state is the window with the last token and the relative token count at each of its
    positions: all that later bytes can depend on, hence finitely many states. ``step``
    compiles a transition when it is first taken. Words go through it side by side, byte by
    byte, by look-ups in an open hash table (key: state and byte; value: next state and
    emitted tokens); words of over ``LONG`` bytes alone, with a dict. When more than ``most``
    transitions are compiled the table starts anew, between ``BLOCK`` bytes of words or within
    a long word, which bounds memory and changes no result.
    """

    LONG = 256
    BLOCK = 1 << 18
    EMPTY = -1
    ZERO = 1 << 15  # a later byte can make tokens fewer, so less than none can be emitted

    def __init__(self, merges: MergeList, end: int = 0, most: int = 600_000):
        self.m, self.most = merges, most
        shown = byte_symbols()
        self.symbols = [*shown, *(chr(ord(c) + end) for c in shown)]  # the second half for a word's last byte
        self._reset()

    def _reset(self, start: tuple = ("", (None,), (0,))) -> None:
        """Forget all but the empty state, whose number is 0, and ``start``, whose number is the last."""
        self.states, self.number = [], {}
        for state in (("", (None,), (0,)), start):
            self._state(*state)
        self.taken: dict[int, int] = {}  # of long words
        self.size = 0
        self._room(16)

    def _room(self, bits: int) -> None:
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, self.EMPTY, "int64"), np.zeros(1 << bits, "int64")

    def _state(self, window: str, lasts: tuple, counts: tuple) -> int:
        key = (sys.intern(window), lasts, counts)
        if (got := self.number.get(key)) is None:
            got = self.number[key] = len(self.states)
            self.states.append(key)
        return got

    def step(self, key: int) -> int:
        """key: state * 512 + byte, 256 more for a word's last byte. (Next state << 16) + ZERO + tokens emitted, of the last byte all that are left."""
        window, lasts, counts = self.states[key >> 9]
        w = window + self.symbols[key & 511]
        t, j = self.m.last_token(w, lasts)
        if key & 256:
            return self.ZERO + counts[j] + 1
        prefixes, k = self.m.prefixes, 0
        while w[k:] not in prefixes and k < len(w):
            k += 1
        lasts, counts = (*lasts[k:], sys.intern(t)), (*counts, counts[j] + 1)
        emitted = counts[k]
        return (self._state(w[k:], lasts, tuple([x - emitted for x in counts[k:]]) if emitted else counts[k:]) << 16) + self.ZERO + emitted

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype("uint64") * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype("int64")

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The keys' places in the table, -1 of those it lacks."""
        at = self._home(keys)
        found = self.keys[at]
        rest = np.flatnonzero(found != keys)
        while len(rest):
            lacking = found[rest] == self.EMPTY
            at[rest[lacking]] = -1
            rest = rest[~lacking]
            at[rest] = (at[rest] + 1) & self.mask
            found[rest] = self.keys[at[rest]]
            rest = rest[found[rest] != keys[rest]]
        return at

    def _put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add distinct keys that the table lacks; at most half of its places are taken."""
        self.size += len(keys)
        if 2 * self.size > len(self.keys):
            held = self.keys != self.EMPTY
            keys, values = np.concatenate([self.keys[held], keys]), np.concatenate([self.values[held], values])
            self._room((2 * len(keys)).bit_length())
        at = self._home(keys)
        while len(keys):
            free = self.keys[at] == self.EMPTY
            self.keys[at[free]] = keys[free]  # of keys with the same place the last stays
            put = self.keys[at] == keys
            self.values[at[put]] = values[put]
            keys, values, at = keys[~put], values[~put], (at[~put] + 1) & self.mask

    def _take(self, keys: np.ndarray) -> np.ndarray:
        """The values of the keys' transitions; new ones are compiled."""
        at = self._find(keys)
        if (at < 0).any():
            new = np.unique(keys[at < 0])
            self._put(new, np.fromiter(map(self.step, new.tolist()), "int64", len(new)))
            at = self._find(keys)
        return self.values[at]

    def counts(self, words: bytes) -> np.ndarray:
        """Token counts of words, none empty, with a line feed after each."""
        text = np.frombuffer(words, "uint8")
        ends = np.flatnonzero(text == 10)
        starts = np.concatenate([[0], ends + 1])[: len(ends)]
        order = np.argsort(ends - starts, kind="stable")
        out = np.zeros(len(ends), "int64")
        size = (ends - starts)[order]
        many = int(np.searchsorted(size, self.LONG, "right"))
        total = np.cumsum(size[:many])
        lo = 0
        while lo < many:
            hi = max(lo + 1, int(np.searchsorted(total, total[lo] + self.BLOCK)))
            out[order[lo:hi]] = self._side_by_side(text, starts[order[lo:hi]], size[lo:hi])
            lo = hi
        for i in order[many:].tolist():
            out[i] = self.count(words[starts[i] : ends[i]])
        return out

    def _side_by_side(self, text: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Token counts of words, the shorter ones first."""
        if self.size > self.most:
            self._reset()
        state, count = np.zeros(len(size), "int64"), np.zeros(len(size), "int64")
        for i in range(int(size[-1])):
            on = int(np.searchsorted(size, i, "right"))
            symbol = text[starts[on:] + i].astype("int64")
            symbol[: int(np.searchsorted(size, i + 1, "right")) - on] += 256
            got = self._take((state[on:] << 9) + symbol)
            count[on:] += (got & 0xFFFF) - self.ZERO
            state[on:] = got >> 16
        return count

    def count(self, word: bytes) -> int:
        """Tokens of a whole word: what the transitions emit, then what the last state still holds."""
        state = total = 0
        for at in range(0, len(word), self.BLOCK):
            if self.size > self.most:
                self._reset(self.states[state])
                state = len(self.states) - 1
            part = word[at : at + self.BLOCK]
            known = self.taken
            last = len(part) - 1 if at + self.BLOCK >= len(word) else -1
            for i, b in enumerate(part):
                key = (state << 9) + b + 256 * (i == last)
                if (got := known.get(key)) is None:
                    got = known[key] = self.step(key)
                    self.size += 1
                total += (got & 0xFFFF) - self.ZERO
                state = got >> 16
        return total
