"""Token boundaries of the public GPT-2 split pattern, found for many texts at once with numpy.

The pattern is ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``. Its
matches are runs of one character class, with three rules on top: one blank before a run belongs to
it; of longer white space before a run the last character is kept apart; an apostrophe that begins a
match takes one of seven endings with it.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import numpy as np
import regex

PATTERN = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
CHUNK_CHARS = 1_000_000  # characters indexed at once; a longer text is one chunk


@functools.cache
def classes() -> np.ndarray:
    """Class of every code point, as the ``regex`` library sees it."""
    table = np.zeros(0x110000, np.uint8)
    points = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "\0" for c in range(0x110000))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, points):
            table[m.start() : m.end()] = kind
    return table


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def token_starts(cp: np.ndarray, doc_start: np.ndarray) -> np.ndarray:
    """For texts joined in ``cp``, whether a token starts at each character. ``doc_start``: positions where texts begin (below ``len(cp)``)."""
    n = len(cp)
    if n == 0:
        return np.zeros(0, bool)
    cls = classes()[cp]
    opens = np.zeros(n + 1, bool)
    opens[doc_start] = True
    opens[n] = True
    space = cls == SPACE
    run = np.empty(n, bool)
    run[0] = True
    np.not_equal(cls[1:], cls[:-1], out=run[1:])
    run |= opens[:n]
    after_blank = np.zeros(n, bool)
    after_blank[1:] = cp[:-1] == 0x20
    after_blank &= ~opens[:n]
    start = run & ~(after_blank & ~space)
    # The last white-space character before a run, in the same text.
    last_space = np.zeros(n, bool)
    last_space[:-1] = space[:-1] & ~space[1:] & ~opens[1:n]
    start |= last_space
    # Endings after an apostrophe.
    at = np.flatnonzero((cp == 0x27) & start & ~after_blank)
    if len(at):
        padded = np.concatenate([cp, np.zeros(3, cp.dtype)])
        limit = np.concatenate([doc_start[1:], [n]])[np.searchsorted(doc_start, at, side="right") - 1]
        a, b = padded[at + 1], padded[at + 2]
        short = np.isin(a, [ord(c) for c in "stmd"]) & (at + 1 < limit)
        long = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        long &= at + 2 < limit
        for mask, width in ((short, 2), (long, 3)):
            p, end = at[mask], limit[mask]
            start[p + 1] = False
            q = p + width
            q = q[q < end]
            start[q[cls[q] == LETTER]] = True
    return start


def chunks(texts: Sequence[str | None], size: int = CHUNK_CHARS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Texts ``i:j`` joined, as (i, j, code points, j - i + 1 borders); null is the empty text."""
    i = 0
    while i < len(texts):
        j, total, parts = i, 0, []
        while j < len(texts) and (j == i or total + len(texts[j] or "") <= size):
            parts.append(texts[j] or "")
            total += len(parts[-1])
            j += 1
        borders = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        yield i, j, code_points("".join(parts)), borders
        i = j


def tokenized(texts: Sequence[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per chunk (i, j, code points, borders, token start positions, first token of each text and one more)."""
    for i, j, cp, borders in chunks(texts):
        starts = np.unique(borders[:-1])
        at = np.flatnonzero(token_starts(cp, starts[starts < len(cp)]))
        yield i, j, cp, borders, at, np.searchsorted(at, borders)
