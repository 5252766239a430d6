"""References to records that do not exist, judged at each row's own time.

Keys are encoded as integers by a dictionary sorted by key, so that a range of codes is a range of
keys. Per key range and month the referenced codes form one compressed bitmap. The target table's spans
become steps: how many spans of a code begin or end with a month. Each key range is swept once over its
months; the steps so far give two bitmaps of the target, keys that were there at some time of the month
and keys that were there all month:

* reference AND-NOT sometime: no record in the whole month, an orphan for certain;
* reference AND sometime AND-NOT always: only these codes need a look at exact times;
* the rest is sound.

The surviving bits are decoded to (code, month), and only rows with such a key are looked at again. The
work depends on rows, spans and months that occur in them, not on how far apart the months are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import cut, strip

RANGE_BITS = 15  # codes per bitmap: 2**15, which are the 4,096 bytes of Spark's bitmap functions


@dataclass(frozen=True)
class Reference:
    """One referring table: its rows, its own id, the reference, the time, and what it points at."""

    table_name: str
    rows: DataFrame
    id: str
    key: str
    time: str
    target: DataFrame
    target_key: str = "id"
    target_from: str = "loaded_at"
    target_to: str | None = None


def normal_key(c: Column) -> Column:
    """Key without surrounding white space, in lower case."""
    return F.lower(strip(c.cast("string")))


def compress(bitmap: bytes) -> bytes:
    """A bitmap as a sorted list of 16-bit positions (tag 0) or, where that is longer, as bits (tag 1)."""
    bits = np.frombuffer(bitmap, np.uint8)
    at = np.flatnonzero(np.unpackbits(bits, bitorder="little")).astype("<u2")
    return b"\0" + at.tobytes() if 2 * len(at) < len(bits) else b"\1" + bits.tobytes()


def expand(data: bytes | None) -> np.ndarray:
    """The bits of a compressed bitmap, eight to a byte, the lowest first; nothing is no bit."""
    out = np.zeros(1 << RANGE_BITS, bool)
    if data is None:
        return np.packbits(out, bitorder="little")
    if data[0]:
        return np.frombuffer(data, np.uint8, offset=1)
    out[np.frombuffer(data, "<u2", offset=1)] = True
    return np.packbits(out, bitorder="little")


@F.pandas_udf(T.BinaryType())
def _compress(bitmaps: pd.Series) -> pd.Series:
    return bitmaps.map(compress)


SWEPT = "relation int, key_range long, month int, gone array<int>, doubtful array<int>"
MOST = 1 << 20  # decoded bits that are given on at once


def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by relation, key range, month and ``what`` (0: steps, 1: references) to the bits that are left of the references."""
    at, out, n = None, [], 0
    for b in batches:
        for relation, key_range, month, what, bits, positions, kinds, steps in zip(*(b[c] for c in ("relation", "key_range", "month", "what", "bits", "positions", "kinds", "steps"))):
            if at != (relation, key_range):
                at, held = (relation, key_range), np.zeros((2, 1 << RANGE_BITS), np.int64)
            if what == 0:
                held[kinds, positions] += steps  # one step for each kind and position
                continue
            ref, some, full = expand(bits), *(np.packbits(h > 0, bitorder="little") for h in held)
            left = [np.flatnonzero(np.unpackbits(x, bitorder="little")).astype(np.int32) for x in (ref & ~some, ref & some & ~full)]
            out.append((relation, key_range, month, *left))
            n += len(left[0]) + len(left[1])
            if n > MOST:
                yield pd.DataFrame(out, columns=["relation", "key_range", "month", "gone", "doubtful"])
                out, n = [], 0
    yield pd.DataFrame(out, columns=["relation", "key_range", "month", "gone", "doubtful"])


def _bitmaps(coded: DataFrame) -> DataFrame:
    """One compressed bitmap per relation, key range and month; map-side combined by the JVM."""
    position = (F.col("code") % (1 << RANGE_BITS)).alias("position")
    none = F.lit(None)
    return (
        coded.select("relation", F.shiftright("code", RANGE_BITS).alias("key_range"), "month", position)
        .groupBy("relation", "key_range", "month")
        .agg(F.bitmap_construct_agg("position").alias("bits"))
        .select("relation", "key_range", "month", F.lit(1).alias("what"), _compress("bits").alias("bits"), *(none.cast(f"array<{k}>").alias(c) for c, k in (("positions", "int"), ("kinds", "int"), ("steps", "bigint"))))
    )


def _steps(coded: DataFrame) -> DataFrame:
    """Per relation, key range and month how many spans of each code begin (positive) or end there: kind 0 at some time of a month, kind 1 all month."""
    first, open_end = month_of(F.col("since")), F.col("until").isNull()
    begins = lambda c: c == F.trunc(c, "month").cast("timestamp")
    whole = F.when(begins(F.col("since")), first).otherwise(first + 1)
    last = month_of(F.col("until"))
    touched = F.when(begins(F.col("until")), last).otherwise(last + 1)
    step = lambda when, month, kind, n: F.when(when, F.struct(month.cast("int").alias("month"), F.lit(kind).alias("kind"), F.lit(n).alias("step")))
    has_whole = open_end | (whole < last)
    every = F.array(step(F.lit(True), first, 0, 1), step(~open_end, touched, 0, -1), step(has_whole, whole, 1, 1), step(has_whole & ~open_end, last, 1, -1))
    one = coded.select("relation", "code", F.explode(every).alias("s")).where("s IS NOT NULL").groupBy("relation", "code", "s.month", "s.kind").agg(F.sum("s.step").alias("step")).where("step != 0")
    listed = one.groupBy("relation", F.shiftright("code", RANGE_BITS).alias("key_range"), "month").agg(F.collect_list(F.struct((F.col("code") % (1 << RANGE_BITS)).cast("int").alias("position"), "kind", "step")).alias("s"))
    return listed.select("relation", "key_range", "month", F.lit(0).alias("what"), F.lit(None).cast("binary").alias("bits"), F.col("s.position").alias("positions"), F.col("s.kind").alias("kinds"), F.col("s.step").alias("steps"))


def month_of(c: Column) -> Column:
    """Months since the year 0."""
    return F.year(c) * 12 + F.month(c) - 1


def orphans(references: list[Reference], hot_rows: int = 1_000_000) -> DataFrame:
    """Rows whose reference led to no record at the row's own time.

    Result: ``table_name``, ``load_month`` (yyyy-MM), ``id``; distinct rows. A target record is there
    from its ``target_from`` on and until its ``target_to`` (null: for ever; without ``target_to`` in
    the reference: for ever). Case and surrounding white space of keys do not matter. References that
    are null or blank refer to nothing and are left out; so are rows without time, as there is no
    moment to judge them at. Target rows without ``target_from`` were never there. Repeated rows are
    judged each at its own time. Empty tables: no rows refer, or every reference is an orphan. Other
    columns of the tables are not read. Referring tables are read twice, targets once. A key that more
    than ``hot_rows`` rows, and a thousandth of all, refer to in one month is spread over several tasks;
    there are at most a thousand such keys, whatever the data.
    """
    parts_r, parts_t, relations = [], [], {}
    for r in references:
        target_id = (r.target, r.target_key)
        relation = next((k for k, v in relations.items() if v[0] is r.target and v[1] == r.target_key), len(relations))
        if relation not in relations:
            relations[relation] = target_id
            until = F.col(r.target_to).cast("timestamp") if r.target_to else F.lit(None).cast("timestamp")
            parts_t.append(
                r.target.select(F.lit(relation).alias("relation"), normal_key(F.col(r.target_key)).alias("key"), F.col(r.target_from).cast("timestamp").alias("since"), until.alias("until"))
                .where("key != '' AND since IS NOT NULL AND (until IS NULL OR until > since)")
            )
        parts_r.append(
            r.rows.select(F.lit(relation).alias("relation"), F.lit(r.table_name).alias("table_name"), F.col(r.id).cast("string").alias("id"), normal_key(F.col(r.key)).alias("key"), F.col(r.time).cast("timestamp").alias("time"))
            .where("key != '' AND time IS NOT NULL")
            .withColumn("month", month_of(F.col("time")))
        )
    rows, targets = parts_r[0], parts_t[0]
    for p in parts_r[1:]:
        rows = rows.unionByName(p)
    for p in parts_t[1:]:
        targets = targets.unionByName(p)

    # Dictionary: distinct keys in key order; the code is the range partition and the place in it.
    referred = cut(rows.groupBy("relation", "key", "month").agg(F.count(F.lit(1)).alias("n")))
    held = cut(targets.distinct())
    keys = referred.select("relation", "key").unionByName(held.select("relation", "key")).distinct()
    # It is cut, because two evaluations could draw the range borders differently.
    dictionary = cut(keys.repartitionByRange("relation", "key").sortWithinPartitions("relation", "key").withColumn("code", F.monotonically_increasing_id()))

    ref = _bitmaps(referred.join(dictionary, ["relation", "key"]).select("relation", "code", "month"))
    steps = _steps(held.join(dictionary, ["relation", "key"]))
    at = ["relation", "key_range", "month", "what"]
    left = ref.unionByName(steps).repartition("relation", "key_range").sortWithinPartitions(*at).mapInPandas(sweep, SWEPT)
    code = F.shiftleft("key_range", RANGE_BITS) + F.col("position")
    bits = F.concat(F.transform("gone", lambda p: F.struct(p.alias("position"), F.lit(True).alias("sure"))), F.transform("doubtful", lambda p: F.struct(p.alias("position"), F.lit(False).alias("sure"))))
    decoded = left.select("relation", "month", "key_range", F.inline(bits)).select("relation", "month", code.alias("code"), "sure")
    suspects = decoded.join(dictionary, ["relation", "code"]).select("relation", "key", "month", "sure")

    # Rows of a hot key are dealt to several tasks, and what is known of the key to each of them.
    hot = max(hot_rows, (referred.agg(F.sum("n")).first()[0] or 0) // 1000)
    heavy = F.broadcast(referred.where(F.col("n") > hot).select("relation", "key", "month", F.ceil(F.col("n") / hot).cast("int").alias("parts")))  # a thousand rows at most
    same = ["relation", "key", "month"]
    parts = F.coalesce("parts", F.lit(1))
    suspects = cut(suspects.join(heavy, same, "left").withColumn("parts", parts))
    dealt = rows.join(heavy, same, "left").withColumn("part", F.pmod(F.xxhash64("id", "time"), parts)).drop("parts")
    each = lambda df: df.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1))).drop("parts")
    hit = dealt.join(each(suspects), [*same, "part"])
    doubtful = each(suspects.where("NOT sure").groupBy("relation", "key").agg(F.max("parts").alias("parts")))
    t = held.join(doubtful, ["relation", "key"]).select(F.col("relation").alias("t_relation"), F.col("key").alias("t_key"), F.col("part").alias("t_part"), "since", "until")
    held_then = (F.col("relation") == F.col("t_relation")) & (F.col("key") == F.col("t_key")) & (F.col("part") == F.col("t_part")) & (F.col("since") <= F.col("time")) & (F.col("until").isNull() | (F.col("until") > F.col("time")))
    # A key that is gone for certain has no span then either.
    return hit.join(t, held_then, "left_anti").select("table_name", F.date_format("time", "yyyy-MM").alias("load_month"), "id").distinct()
