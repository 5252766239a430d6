"""Oversized documents cut at natural boundaries.

Every token border of a text has a strength: end of a paragraph, of a line or list entry, of a
sentence, of a word, or none. A sparse table of range maxima over (strength, position) answers which
is the strongest cut in a piece's permissible window, the rightmost of equals; the next piece starts
the overlap before the cut. All documents of a batch are stepped through together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.tokens import LETTER, NUMBER, SPACE, classes, tokenized

PARAGRAPH, LINE, SENTENCE, WORD, NONE = 4, 3, 2, 1, 0
SENTENCE_ENDS = np.array([ord(c) for c in ".!?…"], np.uint32)
CLOSERS = np.array([ord(c) for c in "\"')]»”’"], np.uint32)


def strengths(cp: np.ndarray, borders: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Strength of the border before each token."""
    n = len(cp)
    cls = classes()[cp]
    space = cls == SPACE
    lines = np.concatenate([[0], np.cumsum(cp == 0x0A)])
    # Start of the white-space run that each position is in.
    index = np.arange(n)
    run_start = np.maximum.accumulate(np.where(space & ~np.concatenate([[False], space[:-1]]), index, 0))
    before = np.maximum(at - 1, 0)
    two = np.maximum(at - 2, 0)
    after_space = space[before]
    # White space of the text before does not count.
    first = borders[np.searchsorted(borders, at, side="right") - 1]
    breaks = np.where(after_space, lines[at] - lines[np.maximum(run_start[before], first)], 0)
    blank = space[at]
    ahead = np.minimum(at + blank, n - 1)
    ended = np.isin(cp[before], SENTENCE_ENDS) | (np.isin(cp[before], CLOSERS) & np.isin(cp[two], SENTENCE_ENDS))
    small = (cls[ahead] == NUMBER) | ((cls[ahead] == LETTER) & _lower(cp[ahead]))
    out = np.where(blank | after_space, WORD, NONE)
    out[blank & ended & ~small] = SENTENCE
    out[breaks == 1] = LINE
    out[breaks >= 2] = PARAGRAPH
    return out.astype(np.int64)


def _lower(cp: np.ndarray) -> np.ndarray:
    values, inverse = np.unique(cp, return_inverse=True)
    return np.array([chr(v).islower() for v in values.tolist()], bool)[inverse] if len(values) else np.zeros(0, bool)


class RangeMaximum:
    """Sparse table: the maximum of any range in two look-ups; levels are built up to the longest range asked for."""

    def __init__(self, values: np.ndarray, longest: int):
        self.levels = [values]
        width = 1
        while 2 * width <= longest and 2 * width <= len(values):
            v = self.levels[-1]
            self.levels.append(np.maximum(v[:-width], v[width:]))
            width *= 2

    def __call__(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Maxima of ``values[low..high]``, both ends included, all of one call's ranges being non-empty."""
        level = np.floor(np.log2(high - low + 1)).astype(int)
        out = np.empty(len(low), self.levels[0].dtype)
        for k in np.unique(level):
            m = level == k
            table = self.levels[k]
            out[m] = np.maximum(table[low[m]], table[high[m] - (1 << k) + 1])
        return out


def cut_points(strength: np.ndarray, first: np.ndarray, last: np.ndarray, limit: int, overlap: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of texts whose tokens are ``first[d]:last[d]``: (text, first token, end token), ordered by text and place."""
    shift = np.int64(max(int(last.max(initial=0)), 1)).item().bit_length() + 1
    table = RangeMaximum((strength << shift) | np.arange(len(strength)), limit)
    place = (1 << shift) - 1
    docs, begin = np.arange(len(first)), first.astype(np.int64)
    out = []
    while len(docs):
        ends = last[docs] - begin <= limit
        out.append((docs[ends], begin[ends], last[docs[ends]]))
        docs, begin = docs[~ends], begin[~ends]
        if not len(docs):
            break
        best = table(begin + least, begin + limit)
        weak = best >> shift == NONE
        if weak.any() and overlap + 1 < least:
            wider = table(begin[weak] + overlap + 1, begin[weak] + limit)
            best[weak] = np.where(wider >> shift > NONE, wider, best[weak])
        cut = best & place
        out.append((docs, begin, cut))
        begin = cut - overlap
    d, a, b = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3
    order = np.lexsort((a, d))
    return d[order], a[order], b[order]


def split_documents(df: DataFrame, key: str = "doc_id", text: str = "text", limit: int = 512, overlap: int = 64, least: int | None = None, oversized_only: bool = True, with_text: bool = True) -> DataFrame:
    """Pieces of at most ``limit`` tokens; each after the first repeats the last ``overlap`` tokens of the one before.

    Result: ``key``, ``n_tokens`` (of the whole text), ``piece_no`` (from 0), ``token_start``,
    ``token_end``, ``char_start``, ``char_end`` and, with ``with_text``, ``piece``. Texts within the limit
    are left out with ``oversized_only``, else they are one piece; an empty or null text is then one
    piece of no tokens. A cut lies at the strongest border at least ``least`` tokens (half the limit)
    after the piece's start, of equal ones at the last; if there is none, an earlier one is taken before
    text is cut within a word. Rows are split each for itself, so repeated rows give repeated pieces, and
    null keys are kept; an empty table gives no pieces. Other columns are not read.
    """
    least = max(overlap + 1, limit // 2) if least is None else least
    if not 0 <= overlap < least <= limit:
        raise ValueError("needs 0 <= overlap < least <= limit")
    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_tokens long, piece_no int, token_start long, token_end long, char_start long, char_end long" + ", piece string" * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, texts = b.column(0), b.column(1).to_pylist()
            for i, j, cp, borders, at, token in tokenized(texts):
                count = np.diff(token)
                chosen = np.flatnonzero(count > limit) if oversized_only else np.arange(j - i)
                if not len(chosen):
                    continue
                strength = strengths(cp, borders, at) if len(at) else np.zeros(0, np.int64)
                d, a, e = cut_points(np.append(strength, 0), token[chosen], token[chosen + 1], limit, overlap, least)
                doc = chosen[d]
                number = np.arange(len(d)) - np.searchsorted(d, d)
                place = np.append(at, len(cp))
                c0, c1 = place[a] - borders[doc], np.where(e == token[doc + 1], borders[doc + 1], place[e]) - borders[doc]
                empty = count[doc] == 0
                c0[empty], c1[empty] = 0, 0
                arrays = [keys.take(pa.array(doc + i)), *(pa.array(x.astype(np.int64)) for x in (count[doc],)), pa.array(number.astype(np.int32))]
                arrays += [pa.array(x.astype(np.int64)) for x in (a - token[doc], e - token[doc], c0, c1)]
                if with_text:
                    arrays.append(pa.array([(texts[k] or "")[x:y] for k, x, y in zip((doc + i).tolist(), c0.tolist(), c1.tolist())], pa.string()))
                names = [key, "n_tokens", "piece_no", "token_start", "token_end", "char_start", "char_end", *["piece"] * with_text]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return df.select(key, F.col(text).cast("string").alias("__text")).mapInArrow(run, schema)
