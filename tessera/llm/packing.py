"""Documents gathered into sequences of fixed capacity with little unused space.

1. Tokens are counted; a text above the capacity gives full pieces and a rest. The histogram of piece
   lengths has at most as many entries as the capacity, whatever the corpus.
2. The configuration linear program over that histogram (how often to use each way of filling one
   sequence) is solved by multiplicative weights: lengths still short of their share become dear, and a
   knapsack dynamic program finds the dearest filling.
3. The solution is rounded down; what is left over is filled in by the same program over the lengths
   left, then by best fit.
4. Pieces take their places by their rank among pieces of equal length. Ranks come from salted groups of
   about ``GROUP`` pieces, so a length that a third of all pieces share is spread over as many tasks as it needs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.tokens import tokenized
from tessera.session import cut

ITERATIONS = 3000  # at most; each is one filling found by dynamic programming
STEPS = (0.02, 0.5)  # part of a length's demand that one filling meets at most: the fewer lengths, the smaller
GRID = 256  # steps of capacity in the dynamic program
GROUP = 1 << 20  # pieces of one length that are ranked in one group


def knapsack(value: np.ndarray, lengths: np.ndarray, capacity: int, stock: np.ndarray, grid: int) -> np.ndarray:
    """Counts of each length in a filling of high value, at most ``stock`` of each.

    The dynamic program works on capacity in steps of ``grid`` tokens, lengths rounded up; the room that
    rounding leaves is used by exchanging a length for a longer one that is still wanted. ``lengths`` ascend.
    """
    live = np.flatnonzero((value > 0) & (stock > 0))
    counts = np.zeros(len(lengths), np.int64)
    if not len(live):
        return counts
    steps = capacity // grid
    coarse = -(-lengths[live] // grid)
    # The dearest length of each coarse size.
    order = np.lexsort((value[live], coarse))
    last = np.flatnonzero(np.append(coarse[order][1:] != coarse[order][:-1], True))
    pick = live[order[last]]
    sizes, worth = coarse[order[last]], value[pick]
    fits = sizes <= steps
    pick, sizes, worth = pick[fits], sizes[fits], worth[fits]
    best = np.zeros(steps + 1)
    choice = np.full(steps + 1, -1)
    upto = np.searchsorted(sizes, np.arange(steps + 1), side="right")
    for c in range(1, steps + 1):
        k = upto[c]
        if k:
            gain = best[c - sizes[:k]] + worth[:k]
            i = int(gain.argmax())
            if gain[i] > best[c - 1]:
                best[c], choice[c] = gain[i], i
                continue
        best[c] = best[c - 1]
    c = steps
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            counts[pick[choice[c]]] += 1
            c -= int(sizes[choice[c]])
    counts = np.minimum(counts, stock)
    room = capacity - int((counts * lengths).sum())
    # Add what still fits, longest first, then exchange one length for the longest that fits in its place.
    while room > 0:
        i = int(np.searchsorted(lengths[live], room, side="right")) - 1
        while i >= 0 and counts[live[i]] >= stock[live[i]]:
            i -= 1
        if i < 0:
            break
        counts[live[i]] += 1
        room -= int(lengths[live[i]])
    for j in np.flatnonzero(counts)[::-1] if room > 0 else ():
        i = int(np.searchsorted(lengths[live], lengths[j] + room, side="right")) - 1
        while i >= 0 and lengths[live[i]] > lengths[j] and counts[live[i]] >= stock[live[i]]:
            i -= 1
        if i >= 0 and lengths[live[i]] > lengths[j]:
            counts[j] -= 1
            counts[live[i]] += 1
            room -= int(lengths[live[i]] - lengths[j])
            if room == 0:
                break
    return counts


def solve(lengths: np.ndarray, demand: np.ndarray, capacity: int, iterations: int = ITERATIONS) -> list[tuple[np.ndarray, float]]:
    """Fractional covering by configurations: (counts, how often), by multiplicative weights.

    No demand is met more than once, so what the fillings hold over the lower bound is only the room they leave.
    """
    weight = lengths / capacity
    grid = max(1, capacity // GRID)
    step = min(max(2 * len(lengths) / iterations, STEPS[0]), STEPS[1])
    used: dict[bytes, list] = {}
    left = np.ones(len(lengths))  # share of each length's demand that is not met yet
    for _ in range(iterations):
        short = left > 0
        if not short.any():
            break
        a = knapsack(np.where(short, weight, 0), lengths, capacity, np.where(short, demand, 0), grid)
        share = a / demand
        held = a > 0
        top = share.max()
        # The length that this filling serves best gets this part of its demand, unless another's is met before.
        amount = min(step / top, (left[held] / share[held]).min())
        used.setdefault(a.tobytes(), [a, 0.0])[1] += amount
        left -= amount * share
        left[left < 1e-9] = 0
        weight *= np.exp(-step * share / top)
    return [(a, x) for a, x in used.values()]


def plan(lengths: np.ndarray, demand: np.ndarray, capacity: int, iterations: int = ITERATIONS) -> list[tuple[dict[int, int], int]]:
    """Whole fillings (count by length) and how often each is used; together they hold every piece exactly once. ``lengths`` ascend.

    The program counts on lengths that fill sequences up together. Where they do not, as with few lengths of more than
    half a sequence, best fit alone may need fewer sequences, and is taken then.
    """
    solved = sorted(solve(lengths, demand, capacity, iterations), key=lambda c: -c[1]) if len(lengths) else []
    made = [_rounded(lengths, demand, capacity, iterations, x) for x in (solved, [])]
    return min(made, key=lambda fillings: sum(times for _, times in fillings))


def _rounded(lengths: np.ndarray, demand: np.ndarray, capacity: int, iterations: int, solved: list[tuple[np.ndarray, float]]) -> list[tuple[dict[int, int], int]]:
    """Fillings rounded down, then of the rest those that leave next to no room, then best fit; without a solution best fit alone."""
    left = demand.astype(np.int64).copy()
    out: list[tuple[dict[int, int], int]] = []

    def use(a: np.ndarray, times: int) -> None:
        if times > 0:
            left[:] -= a * times
            out.append(({int(lengths[i]): int(a[i]) for i in np.flatnonzero(a)}, times))

    if not len(lengths):
        return out
    for a, x in solved:
        held = a > 0
        use(a, min(int(x), int((left[held] // a[held]).min())))
    # Fillings of the lengths left, valued a little above their size, each used as often as the rest allows.
    for _ in range(iterations if solved else 0):
        if (left * lengths).sum() < 8 * capacity:
            break
        a = knapsack((lengths / capacity) ** 1.1, lengths, capacity, left, max(1, capacity // GRID))
        if capacity - int((a * lengths).sum()) > capacity // 500:
            break
        held = a > 0
        use(a, int((left[held] // a[held]).min()))
    # Best fit, longest first, over groups of equal bins.
    bins: dict[int, list[tuple[dict[int, int], int]]] = {}
    for i in np.argsort(-lengths):
        size, todo = int(lengths[i]), int(left[i])
        while todo:
            free = min((f for f in bins if f >= size), default=None)
            if free is None:
                per = capacity // size
                full, rest = divmod(todo, per)
                for count, times in ((per, full), (rest, 1)):
                    if count and times:
                        bins.setdefault(capacity - size * count, []).append(({size: count}, times))
                break
            content, times = bins[free].pop()
            if not bins[free]:
                del bins[free]
            per = min(free // size, todo)
            n = min(times, todo // per)
            if n < times:
                bins.setdefault(free, []).append((content, times - n))
            bins.setdefault(free - per * size, []).append((content | {size: per}, n))
            todo -= per * n
    return out + [b for group in bins.values() for b in group]


def places(fillings: list[tuple[dict[int, int], int]]) -> tuple[dict[int, np.ndarray], int]:
    """For each length rows (first rank, first bin, per bin, offset in the bin), and the number of bins."""
    rows: dict[int, list] = {}
    rank: dict[int, int] = {}
    bins = 0
    for content, times in fillings:
        offset = 0
        for size, count in sorted(content.items(), reverse=True):
            rows.setdefault(size, []).append((rank.get(size, 0), bins, count, offset))
            rank[size] = rank.get(size, 0) + count * times
            offset += size * count
        bins += times
    return {k: np.array(v, np.int64) for k, v in rows.items()}, bins


def document_pieces(df: DataFrame, key: str, text: str, capacity: int) -> DataFrame:
    """Full pieces of texts above the capacity, and the rest or whole of every text."""
    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, piece_no int, token_start long, token_end long, char_start long, char_end long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, texts = b.column(0), b.column(1).to_pylist()
            for i, j, cp, borders, at, token in tokenized(texts):
                count = np.diff(token)
                parts = np.maximum(1, -(-count // capacity))
                doc = np.repeat(np.arange(j - i), parts)
                number = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
                a, e = number * capacity, np.minimum((number + 1) * capacity, count[doc])
                place = np.append(at, len(cp))
                c0 = np.where(number == 0, 0, place[np.minimum(token[doc] + a, len(at))] - borders[doc])
                c1 = np.where(e == count[doc], borders[doc + 1], place[np.minimum(token[doc] + e, len(at))]) - borders[doc]
                c1 = np.where(e == count[doc], borders[doc + 1] - borders[doc], c1)
                arrays = [keys.take(pa.array(doc + i)), pa.array(number.astype(np.int32)), *(pa.array(x.astype(np.int64)) for x in (a, e, c0, c1))]
                yield pa.RecordBatch.from_arrays(arrays, names=[key, "piece_no", "token_start", "token_end", "char_start", "char_end"])

    return df.select(key, F.col(text).cast("string").alias("__text")).mapInArrow(run, schema)


def pack_documents(df: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = 2048, iterations: int = ITERATIONS, group: int = GROUP) -> DataFrame:
    """Places of all documents in sequences of at most ``capacity`` tokens.

    Result, one row for each piece: ``key``, ``piece_no``, ``token_start``, ``token_end``, ``char_start``,
    ``char_end`` (of the text), ``sequence_id``, ``sequence_offset`` (in tokens). A document is cut only if
    it alone is longer than the capacity; its pieces come out whole, each once. A document without tokens
    (empty or null text) has one empty piece at offset 0 of some sequence. Repeated rows are packed each;
    null keys are kept; an empty table gives no rows. Other columns are not read. The driver holds the
    histogram by length, and one number for each ``group`` pieces of one length; the capacity bounds both and the plan but for that.
    """
    pieces = cut(document_pieces(df, key, text, capacity).withColumn("size", (F.col("token_end") - F.col("token_start")).cast("int")))
    totals = {r["size"]: r["n"] for r in pieces.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    salts = {s: -(-n // group) for s, n in totals.items()}
    sizes = sorted(s for s in totals if s > 0)
    many = {s: k for s, k in salts.items() if k > 1}  # lengths that more than one group ranks
    parts = F.coalesce(F.create_map(*(F.lit(x) for e in many.items() for x in e))[F.col("size")], F.lit(1)) if many else F.lit(1)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64(key, "piece_no"), parts).cast("int"))
    counted = {(r["size"], r["salt"]): r["n"] for r in salted.where(F.col("size").isin(list(many))).groupBy("size", "salt").agg(F.count(F.lit(1)).alias("n")).collect()} if many else {}
    # Ranks before each group, length after length.
    begins = dict(zip(sizes, np.cumsum([0, *(salts[s] for s in sizes)]).tolist()))
    base = np.zeros(sum(salts[s] for s in sizes), np.int64)
    for s in many.keys() & begins.keys():
        n = [counted.get((s, k), 0) for k in range(salts[s])]
        base[begins[s] : begins[s] + salts[s]] = np.cumsum(n) - n
    where, bins = places(plan(np.array(sizes, np.int64), np.array([totals[s] for s in sizes], np.int64), capacity, iterations))
    shared = df.sparkSession.sparkContext.broadcast((begins, base, where, max(bins, 1)))
    ranked = salted.withColumn("rank", F.row_number().over(Window.partitionBy("size", "salt").orderBy(key, "piece_no")) - 1)
    kept = [key, "piece_no", "token_start", "token_end", "char_start", "char_end"]
    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, piece_no int, token_start long, token_end long, char_start long, char_end long, sequence_id long, sequence_offset long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins, base, where, bins = shared.value
        for b in batches:
            size, salt, rank = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("size", "salt", "rank"))
            seq, offset = rank % bins, np.zeros(len(rank), np.int64)  # empty pieces, spread over the sequences
            for s in np.unique(size[size > 0]).tolist():
                m = np.flatnonzero(size == s)
                r = rank[m] + base[begins[s] + salt[m]]
                table = where[s]
                seg = table[np.searchsorted(table[:, 0], r, side="right") - 1]
                q = r - seg[:, 0]
                seq[m], offset[m] = seg[:, 1] + q // seg[:, 2], seg[:, 3] + q % seg[:, 2] * s
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in kept), pa.array(seq), pa.array(offset)], names=[*kept, "sequence_id", "sequence_offset"])

    return ranked.select(*kept, "size", "salt", "rank").mapInArrow(run, schema)
