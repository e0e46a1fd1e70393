"""Words of ASCII letters, digits and all other characters, found in batches of whole texts."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

#: A word, in lower-cased UTF-8: as bytes, all characters beyond ASCII are runs of 0x80 to 0xFF.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
GAP = re.compile(rb"[^0-9a-z\x80-\xff]")
#: Bytes of text that a task holds as words at a time.
AT_ONCE = 1 << 20


def last_words(data: bytes, end: int, n: int) -> list[bytes]:
    """The last ``n`` words of data[:end], which ends between words."""
    size = 64
    while True:
        found = WORD.findall(data, max(0, end - size), end)
        if len(found) > n or size >= end:  # the first found could be the end of a longer one
            return found[-n:] if n else []
        size *= 4


def cuts(data: bytes, most: int) -> Iterator[tuple[int, int]]:
    """Spans of about ``most`` bytes that end between words; a longer word is a span of its own."""
    at = 0
    while len(data) - at > most:
        gap = GAP.search(data, at + most)
        end = gap.end() if gap else len(data)
        yield at, end
        at = end
    yield at, len(data)


def pieces(texts: Iterable[str | None], most: int = AT_ONCE, carry: int = 0) -> Iterator[list[tuple[int, bytes, int]]]:
    """Lists of (text number, lower-cased bytes, words carried over) that hold about ``most`` bytes together.

    A longer text comes in several pieces, each beginning with the ``carry`` last words of
    the text before it. Only A-Z are lower-cased; null is the empty text.
    """
    held, size = [], 0
    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8", "replace").lower()
        for a, b in cuts(data, most):
            lead = last_words(data, a, carry) if a else []
            part = b" ".join([*lead, data[a:b]]) if a else data if b == len(data) else data[a:b]
            if held and size + len(part) > most:
                yield held
                held, size = [], 0
            held.append((i, part, len(lead)))
            size += len(part)
    if held:
        yield held
