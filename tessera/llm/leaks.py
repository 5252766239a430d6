"""Evaluation texts leaking into training text.

Words (letters and digits without case, accents and marks of presentation) are hashed; spaced seeds are
hashes over fixed masks that leave out some positions of a word window, so that a changed word at such
a position does not hide a match. Seeds of all documents are looked up among those of the items; around
hits, whole diagonals of both texts are compared word by word, and documents with enough of an item's
words in agreement become candidates with their runs of equal words. How many different texts carry a
stretch of an item is counted over the whole corpus, copies under other ids once; stretches that many
carry are standing text and do not count. Runs are then chained, allowing a few changed, dropped or added words between them and
one longer piece of other text.
"""

from __future__ import annotations

import functools
import hashlib
import html
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut

# Masks over a window of words: 1 counts, 0 is left out.
MASKS = ("111111", "11101111", "110101011")
LEAST_HITS = 5  # seeds in agreement, before words are counted
LEAST_COVER = 16  # words of an item in agreement, before a document is a candidate
STANDING_RUN = 15  # words in a row that make a stretch of standing text
STANDING_SHARE, STANDING_LEAST = 0.013, 4  # of different texts that carry it, and texts at least
CHUNK_CHARS = 1_000_000
SPAN = 1 << 32  # room for the difference of two word positions
INDEX_BYTES = 64 << 20  # memory that the index of one pass may take in each Python worker
MOST_PASSES = 4  # over the documents; with more items than they take, seeds are joined by a shuffle
FILTER_BITS = 1 << 27  # of the filter that is sent to all tasks then
WORD_BYTES = 72  # what the index holds for each word of an item, its filters included

# Signs that character recognition takes for each other.
ALIKE = ("o0", "l1i", "s5", "ec")

WORD_GAP, DROP = 0, 1
_HYPHEN = re.compile(r"(?<=[^\W_])[-\u00ad\u2010]\r?\n[ \t>|#*]*(?=[^\W_])")
_ESCAPE = re.compile(r"\\u([0-9a-fA-F]{4})")
_CONTROL = re.compile(r"\\[nrtbf]")
_ENTITY = re.compile(r"&#?\w{1,31};")
_TAG = re.compile(r"</?[A-Za-z!][^<>]{0,300}>")


def plain(text: str) -> str:
    """Text without escapes, markup and hyphens at line ends."""
    if "\\" in text:
        text = _CONTROL.sub(" ", _ESCAPE.sub(lambda m: chr(int(m[1], 16)) if not 0xD800 <= int(m[1], 16) < 0xE000 else " ", text))
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "&" in text:
        text = _ENTITY.sub(lambda m: html.unescape(m[0]), text)
    if "-\n" in text or "-\r" in text or "\u00ad" in text or "\u2010" in text:
        text = _HYPHEN.sub("", text)
    return text.replace("\0", " ")


@functools.cache
def folding() -> np.ndarray:
    """Base letter or digit of each code point; 0 separates words, 1 vanishes (combining marks, soft hyphens, joiners)."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if 0xD800 <= c < 0xE000 or 0x3400 <= c < 0xA000 or 0xAC00 <= c < 0xD7A4 or c >= 0x1F000:
            continue
        ch = chr(c)
        kind = unicodedata.category(ch)
        if kind[0] == "M" or kind == "Cf":
            table[c] = DROP
        elif kind[0] in "LN":
            base = next((x for x in unicodedata.normalize("NFKD", ch).casefold() if unicodedata.category(x)[0] in "LN"), ch)
            table[c] = ord(unicodedata.normalize("NFKD", base)[0])
    for signs in ALIKE:
        for ch in signs[1:]:
            table[table == ord(ch)] = ord(signs[0])
    for low, high in ((0x3400, 0xA000), (0xAC00, 0xD7A4), (0x20000, 0x32000)):
        table[low:high] = np.arange(low, high)
    return table


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_POWERS = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in a row, and where each text's words begin (one entry more than texts)."""
    joined = "\0".join(map(plain, texts))
    raw = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    cp = folding()[raw]
    keep = cp != DROP
    if not keep.all():
        raw, cp = raw[keep], cp[keep]
    word = cp != WORD_GAP
    opens = word.copy()
    opens[1:] &= ~word[:-1]
    first = np.flatnonzero(opens)
    breaks = np.flatnonzero(raw == 0)
    begins = np.concatenate([[0], np.searchsorted(first, breaks), [len(first)]]).astype(np.int64)
    if not len(first):
        return np.zeros(0, np.uint64), begins
    at = np.flatnonzero(word)
    starts = np.flatnonzero(opens[at])
    lengths = np.diff(np.append(starts, len(at)))
    value = (cp[at].astype(np.uint64) + np.uint64(7)) * _POWERS[(np.arange(len(at)) - np.repeat(starts, lengths)) & 63]
    return _mix(np.add.reduceat(value, starts)), begins


def seeds(h: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the counting words of the mask's window at each position."""
    n = len(h) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k, bit in enumerate(mask):
        if bit == "1":
            out += h[k : k + n] * _POWERS[k]
    return _mix(out)


def _distinct(x: np.ndarray) -> np.ndarray:
    return np.unique(x, sorted=False)


class Items:
    """Seeds of the test items; plain arrays, so it can be broadcast."""

    def __init__(self, ids: list, texts: list[str]):
        self.ids = ids
        self.hashes, self.begins = word_hashes(texts)
        self.tables = []
        for mask in MASKS:
            s = seeds(self.hashes, mask)
            pos = np.arange(len(s))
            inside = np.searchsorted(self.begins, pos, side="right") == np.searchsorted(self.begins, pos + len(mask) - 1, side="right")
            s, pos = s[inside], pos[inside]
            order = np.argsort(s, kind="stable")
            s, pos = s[order], pos[order].astype(np.int32)
            size = 1 << max(16, (4 * len(s)).bit_length())
            filt = np.zeros(size, bool)
            filt[(s & np.uint64(size - 1)).astype(np.int64)] = True
            self.tables.append((mask, s, pos, filt))

    def nbytes(self) -> int:
        return self.hashes.nbytes + self.begins.nbytes + sum(s.nbytes + pos.nbytes + filt.nbytes for _, s, pos, filt in self.tables)

    def hits(self, h: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, str]]:
        """Per mask (word positions in ``h``, word positions among the items) of equal seeds."""
        for mask, s, pos, filt in self.tables:
            d = seeds(h, mask)
            if not len(d) or not len(s):
                continue
            may = np.flatnonzero(filt[(d & np.uint64(len(filt) - 1)).astype(np.int64)])
            low, high = np.searchsorted(s, d[may]), np.searchsorted(s, d[may], side="right")
            n = high - low
            at = np.repeat(may, n)
            yield at, pos[np.repeat(low, n) + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)].astype(np.int64), mask


def copies(h: np.ndarray, begins: np.ndarray) -> list[int | None]:
    """One number for each text, equal where all words are; none for texts without words."""
    return [int.from_bytes(hashlib.blake2b(h[a:b].tobytes(), digest_size=8).digest(), "little", signed=True) if b > a else None for a, b in zip(begins[:-1].tolist(), begins[1:].tolist())]


def spans(starts: list[int], sizes: list[int]) -> tuple[list[int], list[int]]:
    """Where the long runs of one text begin and end in the item, overlapping ones joined, so that no word counts twice."""
    froms, tos = [], []
    for a, n in sorted(zip(starts, sizes)):
        if n < STANDING_RUN:
            continue
        if tos and a <= tos[-1]:
            tos[-1] = max(tos[-1], a + n)
        else:
            froms.append(a)
            tos.append(a + n)
    return froms, tos


def candidates(items: Items, h: np.ndarray, begins: np.ndarray) -> Iterator[tuple[int, int, list[int], list[int], list[int]]]:
    """(text, item, item positions, text positions, lengths of runs of equal words), for texts that agree with an item in enough words."""
    if not len(h):
        return
    n_items, n_words = len(items.ids), len(items.hashes)
    item_of = np.repeat(np.arange(n_items), np.diff(items.begins))
    hits = [(at, pos, mask) for at, pos, mask in items.hits(h) if len(at)]
    if not hits:
        return
    # Few hits cannot cover enough words: each covers at most a mask's width.
    pairs = [(np.searchsorted(begins, at, side="right") - 1) * n_items + item_of[pos] for at, pos, _ in hits]
    pair, n = np.unique(np.concatenate(pairs), return_counts=True)
    some = pair[n >= LEAST_HITS]
    if not len(some):
        return
    codes, diags = [], []
    for (at, pos, mask), mine in zip(hits, pairs):
        m = some[np.minimum(np.searchsorted(some, mine), len(some) - 1)] == mine
        at, pos, mine = at[m], pos[m], mine[m]
        diags.append(_distinct(mine * SPAN + (at - pos + SPAN // 2)))
        own = mine // n_items * n_words + pos
        codes += [own + k for k, bit in enumerate(mask) if bit == "1"]
    # Covered item words of each (text, item).
    code = _distinct(np.concatenate(codes))
    pair, cover = np.unique(code // n_words * n_items + item_of[code % n_words], return_counts=True)
    good = pair[cover >= LEAST_COVER]
    if not len(good):
        return
    both = np.sort(_distinct(np.concatenate(diags)))
    owner, diag = both // SPAN, both % SPAN - SPAN // 2
    cuts, ends = np.searchsorted(owner, good), np.searchsorted(owner, good, side="right")
    for g, x, y in zip(good.tolist(), cuts.tolist(), ends.tolist()):
        d, i = divmod(g, n_items)
        lo, hi = begins[d], begins[d + 1]
        i0, i1 = items.begins[i], items.begins[i + 1]
        starts, places, sizes = runs_of(h[lo:hi], items.hashes[i0:i1], diag[x:y] - lo + i0)
        yield d, i, starts, places, sizes


def runs_of(text: np.ndarray, item: np.ndarray, diagonals: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """Runs of equal words of an item in a text on the given diagonals (place in the text less place in the item) and their neighbours: item places, text places, lengths."""
    shared = set(diagonals.tolist())
    near = np.array(sorted({v + k for v in shared for k in range(-2, 3)}))
    own = np.array([v in shared for v in near.tolist()])
    places = np.arange(len(item))[None, :] + near[:, None]
    equal = np.zeros((len(near), len(item) + 2), bool)
    equal[:, 1:-1] = (places >= 0) & (places < len(text)) & (text.take(places, mode="clip") == item)
    row, start = np.nonzero(equal[:, 1:] & ~equal[:, :-1])
    _, stop = np.nonzero(equal[:, :-1] & ~equal[:, 1:])
    size = stop - start
    keep = (size >= 3) | (own[row] & (size >= 2))
    row, start, size = row[keep], start[keep], size[keep]
    return start.tolist(), (start + near[row]).tolist(), size.tolist()


def leaked_words(starts, places, sizes, standing: set[int], bridge: int = 3) -> tuple[int, int]:
    """Longest stretch of an item that its runs in a text make up in order, as (words, changes).

    A stretch has one piece or, if other text stands between, two. Between two runs of a piece at most
    ``bridge`` words are changed, dropped or added, each a change. A second piece must follow the first in
    the item; pieces have at least 8 words, and 15 if words are missing where they part. Changes are at
    most a tenth of the words, in stretches of 50 words or more an eighth; two pieces with changes have 40
    words or more, as sentences of one mould that stand near each other would else be taken for a stretch.
    Of all stretches that this allows the one with most unchanged words is given, of equals the longest; a
    chain of runs is only dropped where another is no worse for anything that may follow.
    """
    runs = []
    for i, d, n in sorted(zip(starts, places, sizes)):
        k = 0
        while k < n:  # words of standing text split a run
            if i + k in standing:
                k += 1
                continue
            e = k
            while e < n and i + e not in standing:
                e += 1
            runs.append((i + k, d + k, e - k))
            k = e
    best = (0, 0)
    if not runs:
        return best
    last = max(i + n for i, _, n in runs)
    # States by where their last run ends in the text, with its end in the item: (first item word, changes) of one
    # piece, and (first item word, changes, item word from which the second piece is long enough) of two.
    ones: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
    twos: dict[int, list[tuple[int, list[tuple[int, int, int]]]]] = {}
    # For a second piece, (place, first item word, changes) of one piece by its end in the item: of two states the one
    # that is no worse in all three opens every second piece that the other opens, and no later.
    opens: dict[int, list[tuple[int, int, int]]] = {}
    for i, d, n in runs:
        end, place = i + n, d + n
        one, two = [(i, 0)], []
        # Only states that end less than ``bridge`` before the run, or within it, can be continued by it.
        for p in range(d - bridge, place):
            for table, new in ((ones, one), (twos, two)):
                for e, states in table.get(p, ()):
                    over = max(e - i, p - d, 0)
                    gap = i + over - e
                    cost = max(gap, d + over - p)
                    if over < n and cost <= bridge and not any(e + g in standing for g in range(gap)):
                        new += [(s[0], s[1] + cost, *s[2:]) for s in states]
        for e in range(i - bridge, end):
            for p, first, changes in opens.get(e, ()):
                over = max(e - i, p - d, 0)
                gap = i + over - e
                least = 15 if gap else 8
                if over < n and gap <= bridge < max(gap, d + over - p) and e - first >= least and not any(e + g in standing for g in range(gap)):
                    two.append((first, changes + gap, i + over + least))
        # More changes than an eighth of all words that can follow never come right again.
        one = _foremost([s for s in one if s[1] * 8 <= last - s[0]])
        two = _foremost([(f, c, max(q, end)) for f, c, q in two if c * 8 <= last - f])
        for first, changes, *q in one + two:
            words = end - first
            if q and (q[0] > end or (changes and words < 40)):
                continue
            if changes <= words / (10 if words < 50 else 8) and (words - changes, words) > (best[0] - best[1], best[0]):
                best = (words, changes)
        ones.setdefault(place, []).append((end, one))
        if two:
            twos.setdefault(place, []).append((end, two))
        opens[end] = _foremost(opens.get(end, []) + [(place, *s) for s in one])
    return best


def _foremost(states: list[tuple]) -> list[tuple]:
    """The states that no other is at least as low as in every entry."""
    if len(states) < 2:
        return states
    kept: list[tuple] = []
    for s in sorted(set(states)):  # one that is no higher than another in all entries comes before it
        if not any(all(x <= y for x, y in zip(k, s)) for k in kept):
            kept.append(s)
    return kept


def _row_schema(kind: str) -> str:
    return f"copy long, doc {kind}, item long, starts array<int>, places array<long>, sizes array<int>, froms array<int>, tos array<int>"


def leaks(documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", least_words: int = 25, index_bytes: int = INDEX_BYTES, standing_share: float = STANDING_SHARE, standing_least: int = STANDING_LEAST, most_passes: int = MOST_PASSES) -> DataFrame:
    """Documents that carry at least ``least_words`` words in a row of an item's own wording.

    Result: distinct rows of ``key``, ``item_key``, and ``words`` and ``changes`` of the longest stretch found.
    Case, accents, punctuation, markup, escapes and line breaks do not matter; up to one word in ten may be
    changed, dropped or added; other text may stand between two pieces. Stretches of at least
    ``STANDING_RUN`` words that at least the ``standing_share`` of all different texts carry (and at least
    ``standing_least``) do not count; texts of the same words are one, under however many ids. Null and empty texts leak nothing; rows without key are left out;
    repeated documents give one row; empty tables give none. Other columns are not read. The items are
    gathered and sent to all tasks as an index of at most ``index_bytes``; what is more is taken in several passes
    over the documents, so that memory on the driver and in the workers stays bounded, however many items there
    are. A pass takes an item word for each ``WORD_BYTES``. If more than ``most_passes`` were needed, seeds of documents
    and items are joined by a shuffle instead, which reads the documents twice, whatever the number of items.
    """
    tests = items.select(F.col(item_key).alias("k"), F.col(item_text).cast("string").alias("t")).where("k IS NOT NULL AND t IS NOT NULL").distinct()
    size = tests.agg(F.sum(F.regexp_count("t", F.lit(r"[\p{L}\p{N}]+")))).first()[0] or 0  # words
    passes = max(1, -(-int(size) * WORD_BYTES // index_bytes))
    kind = documents.schema[key].dataType.simpleString()
    item_kind = items.schema[item_key].dataType.simpleString()
    rows = documents.select(F.col(key).alias("doc"), F.col(text).cast("string").alias("text")).where("doc IS NOT NULL AND text IS NOT NULL")
    limit = lambda copies_: max(standing_least, standing_share * copies_.select("copy").distinct().count())
    if passes > most_passes:
        numbered = cut(tests.withColumn("item", F.monotonically_increasing_id()))
        seen, cand = _joined_candidates(rows, numbered, kind)
        judged = _judged(cand, f"copy long, {_FOUND}", limit(seen), least_words)
        found = judged.join(seen.select("copy", "doc"), "copy").join(numbered.select("item", F.col("k").alias("item_id")), "item")
    else:
        found, high = None, None
        for p in range(passes):
            part = tests.where(F.pmod(F.xxhash64("k", "t"), F.lit(passes)) == p).orderBy("k", "t").collect()
            index = Items([r["k"] for r in part], [r["t"] for r in part])
            shared = documents.sparkSession.sparkContext.broadcast(index)
            cand = cut(_candidates_of(rows, shared, kind))
            shared.destroy()  # the candidates are written down
            if high is None:  # every pass has all texts
                high = limit(cand)
            names = documents.sparkSession.createDataFrame([(i, str(k)) for i, k in enumerate(index.ids)], "item long, item_id string")
            one = _judged(cand.where("item >= 0"), f"doc {kind}, {_FOUND}", high, least_words).join(F.broadcast(names), "item")  # as many rows as items in this pass
            found = one if found is None else found.unionByName(one)
    return found.select(F.col("doc").alias(key), F.col("item_id").cast(item_kind).alias(item_key), "words", "changes").groupBy(key, item_key).agg(F.max("words").alias("words"), F.min("changes").alias("changes"))


def _candidates_of(rows: DataFrame, shared: Broadcast, kind: str) -> DataFrame:
    """Rows of candidates, and a row with item -1 for each other text that has words."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for b in batches:
            keys, column = b.column(0), b.column(1).to_pylist()
            i = 0
            while i < len(column):
                j, total, part = i, 0, []
                while j < len(column) and (j == i or total + len(column[j] or "") <= CHUNK_CHARS):
                    part.append(column[j] or "")
                    total += len(part[-1])
                    j += 1
                h, begins = word_hashes(part)
                copy = copies(h, begins)
                rows = [(*r, *spans(r[2], r[4])) for r in candidates(items, h, begins)]
                seen = {r[0] for r in rows}
                rows += [(d, -1, [], [], [], [], []) for d, c in enumerate(copy) if c is not None and d not in seen]
                if rows:
                    d, it, s, p, z, a, e = zip(*rows)
                    ints = pa.list_(pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([copy[k] for k in d], pa.int64()), keys.take(pa.array(np.array(d) + i)), pa.array(it, pa.int64()), pa.array(s, ints), pa.array(p, pa.list_(pa.int64())), pa.array(z, ints), pa.array(a, ints), pa.array(e, ints)],
                        names=["copy", "doc", "item", "starts", "places", "sizes", "froms", "tos"])
                i = j

    return rows.mapInArrow(search, _row_schema(kind))


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    """Keys and texts of batches, in chunks of bounded length."""
    for b in batches:
        column, i = b.column(1).to_pylist(), 0
        while i < len(column):
            j, total = i, 0
            while j < len(column) and (j == i or total + len(column[j]) <= CHUNK_CHARS):
                total += len(column[j])
                j += 1
            yield b.column(0).slice(i, j - i), column[i:j]
            i = j


def _joined_candidates(rows: DataFrame, numbered: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """Documents with the number of their text (``doc``, ``copy``), and candidates by ``copy``, from a join of seeds.

    A filter of ``FILTER_BITS`` bits, made of the items' seeds, keeps back nearly all seeds of documents that no item has;
    only what passes is moved. Texts of the same words count once from there on.
    """

    def item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _chunked(batches):
            index = Items(list(range(len(texts))), texts)
            owner = np.repeat(np.arange(len(texts)), np.diff(index.begins))
            for m, (_, s, pos, _) in enumerate(index.tables):
                own = owner[pos]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), m, np.int8)), pa.array(s.view(np.int64)), ids.take(pa.array(own)), pa.array((pos - index.begins[own]).astype(np.int32))], names=["mask", "seed", "item", "pos"])

    held = cut(numbered.select("item", "t").mapInArrow(item_seeds, "mask tinyint, seed long, item long, pos int"))
    place = F.pmod("seed", F.lit(FILTER_BITS))
    parts = held.groupBy(F.expr(f"CAST(pmod(seed, {FILTER_BITS}) DIV 32768 AS INT)").alias("part")).agg(F.bitmap_construct_agg(place % 32768).alias("bits")).collect()  # FILTER_BITS / 8 bytes at most
    bits = np.zeros((FILTER_BITS // 32768, 4096), np.uint8)
    for r in parts:
        bits[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    shared = rows.sparkSession.sparkContext.broadcast(bits.ravel())

    def document_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for keys, texts in _chunked(batches):
            h, begins = word_hashes(texts)
            found = []
            for m, mask in enumerate(MASKS):
                s = seeds(h, mask)
                at = (s.view(np.int64) % FILTER_BITS).astype(np.int64)
                may = np.flatnonzero(bits[at >> 3] >> (at & 7).astype(np.uint8) & 1)
                owner = np.searchsorted(begins, may, side="right") - 1
                inside = may + len(mask) <= begins[owner + 1]
                may, owner = may[inside], owner[inside]
                found.append((owner, np.full(len(may), m, np.int8), s[may].view(np.int64), (may - begins[owner]).astype(np.int32)))
            owner, mask_, seed, pos = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(owner, kind="stable")
            offsets = pa.array(np.searchsorted(owner[order], np.arange(len(texts) + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x[order])) for x in (mask_, seed, pos)]
            yield pa.RecordBatch.from_arrays([keys, pa.array(copies(h, begins), pa.int64()), *lists], names=["doc", "copy", "mask", "seed", "pos"])

    seen = cut(rows.mapInArrow(document_seeds, f"doc {kind}, copy long, mask array<tinyint>, seed array<long>, pos array<int>").where("copy IS NOT NULL"))
    shared.destroy()
    asked = seen.select("copy", "doc", F.explode(F.arrays_zip("mask", "seed", "pos")).alias("s")).groupBy("copy", "s.mask", "s.seed", F.col("s.pos").alias("at")).agg(F.min("doc").alias("doc"))
    hit = F.struct("mask", "pos", (F.col("at") - F.col("pos")).alias("diagonal"))
    both = asked.join(held, ["mask", "seed"]).groupBy("copy", "item").agg(F.min("doc").alias("doc"), F.collect_set(hit).alias("hits")).where(F.size("hits") >= LEAST_HITS)
    texts = both.join(rows, "doc").join(numbered.select("item", "t"), "item").select("copy", "item", "text", "t", F.col("hits.mask").alias("mask"), F.col("hits.pos").alias("pos"), F.col("hits.diagonal").alias("diagonal"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for copy, item, text, t, mask, pos, diagonal in zip(*(b[c] for c in b.columns)):
                cover = np.unique(np.concatenate([pos[mask == m] + k for m, bits_ in enumerate(MASKS) for k, bit in enumerate(bits_) if bit == "1"]))
                if len(cover) < LEAST_COVER:
                    continue
                h, begins = word_hashes([text])
                if copies(h, begins)[0] != copy:
                    continue  # another text under the same key
                starts, places, sizes = runs_of(h, word_hashes([t])[0], diagonal)
                out.append((copy, item, starts, places, sizes, *spans(starts, sizes)))
            yield pd.DataFrame(out, columns=["copy", "item", "starts", "places", "sizes", "froms", "tos"])

    schema = "copy long, item long, starts array<int>, places array<long>, sizes array<int>, froms array<int>, tos array<int>"
    return seen, cut(texts.mapInPandas(compare, schema).dropDuplicates(["copy", "item"]))


_FOUND = "item long, words int, changes int"


def _judged(cand: DataFrame, schema: str, high: float, least_words: int) -> DataFrame:
    """Candidates whose longest stretch without standing text is long enough; the first column of ``schema`` is passed on."""
    owner = schema.split()[0]
    # How many different texts carry each word of an item within a long run: +1 where a run begins, -1 after it.
    long = cand.select("copy", "item", F.explode(F.arrays_zip("froms", "tos")).alias("r")).select("copy", "item", "r.froms", "r.tos").distinct()
    steps = long.select("item", F.explode(F.array(F.struct(F.col("froms").alias("at"), F.lit(1).alias("step")), F.struct(F.col("tos").alias("at"), F.lit(-1).alias("step")))).alias("s"))
    steps = steps.groupBy("item", F.col("s.at").alias("at")).agg(F.sum("s.step").alias("step"))
    w = Window.partitionBy("item").orderBy("at")
    standing = (
        steps.withColumn("carried", F.sum("step").over(w)).withColumn("next", F.lead("at").over(w)).where(F.col("carried") >= high)
        .groupBy("item").agg(F.flatten(F.collect_list(F.sequence("at", F.col("next") - 1))).alias("standing"))
    )

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [leaked_words(s, p, z, set() if o is None else set(o.tolist())) for s, p, z, o in zip(b["starts"], b["places"], b["sizes"], b["standing"])]
            out = pd.DataFrame({owner: b[owner], "item": b["item"], "words": [g[0] for g in got], "changes": [g[1] for g in got]})
            yield out[out["words"] >= least_words]

    return cand.join(standing, "item", "left").mapInPandas(judge, schema)
