"""What changed between full snapshots: a merge of sorted range files.

Every snapshot is kept as files, one for each key range, sorted by key; all snapshots share the borders
of their ranges. A new snapshot is moved once, into its own files, and none of the older ones is
touched. Two consecutive snapshots are compared range by range: their two files are read side by side,
each with a pointer that moves on to the smaller of the two last keys at hand.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import blank_to_empty, open_path, shared_folder

ROWS = 1 << 16  # rows that are held of each file at a time
RANGE_ROWS = 1 << 20  # rows of all snapshots in one range
SAMPLED = 1 << 17  # keys that the borders of the ranges are drawn from, at most


@dataclass(frozen=True)
class Kept:
    """Files of snapshots: folder, borders of the ranges (ascending; range ``i`` ends before border ``i``), files by snapshot and range."""

    folder: str
    columns: tuple[str, ...]
    borders: tuple[str, ...]
    files: dict[tuple[str, int], str]

    def snapshots(self) -> list[str]:
        return sorted({s for s, _ in self.files})


def content_digest(values: list[Column]) -> Column:
    """128 bits of all values; each is told from the next by its length."""
    return F.unhex(F.md5(F.concat_ws("", *(x for v in values for x in (F.length(v).cast("string"), F.lit(":"), v)))))


def range_borders(keys: DataFrame, ranges: int | None = None) -> tuple[str, ...]:
    """Borders of about equally filled ranges of the first column, from a sample whose size is bounded; as many ranges as the keys fill, and one for each core at least."""
    n = keys.count()
    ranges = ranges or max(1, keys.sparkSession.sparkContext.defaultParallelism, -(-n // RANGE_ROWS))
    share = min(1.0, SAMPLED / 2 / max(n, 1))
    drawn = np.array(sorted({r[0] for r in (keys if share == 1 else keys.sample(share, 17)).limit(SAMPLED).collect()}, key=lambda k: k.encode()), object)
    at = [len(drawn) * i // ranges for i in range(1, ranges)]
    return tuple(dict.fromkeys(drawn[i] for i in at if i))


def keep_snapshots(df: DataFrame, snapshot: str, key: str, columns: list[str], order: tuple[str, ...] = (), exact_columns: bool = True, kept: Kept | None = None, ranges: int | None = None) -> Kept:
    """Write the snapshots in ``df`` as sorted range files next to those that ``kept`` has; only the rows of ``df`` are moved.

    A file holds a range's keys with the columns themselves or, without ``exact_columns``, a digest of 128 bits of
    them. Of several records with one key in one snapshot the greatest by ``order`` and then by content is kept:
    batches are thinned out before the shuffle, so that a key that is delivered over and over is no hot spot. The
    driver holds the borders and one path for each range and snapshot. Tasks write under names of their own and the
    result names those that count, so that a task that is repeated does no harm.
    """
    spark = df.sparkSession
    tidy_key, tag = blank_to_empty(F.col(key).cast("string")), blank_to_empty(F.col(snapshot).cast("string"))
    rows = df.where((tidy_key != "") & (tag != ""))
    if kept is None:
        kept = Kept(posixpath.join(shared_folder(spark), f"snapshots-{uuid.uuid4().hex}"), tuple(columns), range_borders(rows.select(tidy_key.alias("k")), ranges), {})
    values = [blank_to_empty(F.col(c).cast("string")) for c in columns]
    content = [v.alias(f"c{i}") for i, v in enumerate(values)] if exact_columns else [content_digest(values).alias("c0")]
    orders = [f"o{i}" for i in range(len(order))]
    tidy = rows.select(tag.alias("at"), tidy_key.alias("k"), *(F.col(c).alias(o) for c, o in zip(order, orders)), *content)
    held = [c for c in tidy.columns if c[0] == "c"]
    sort = [*orders, *held]
    borders = spark.sparkContext.broadcast(kept.borders)  # one key for each range

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each batch the last record of each key, with the range it belongs to."""
        edge = np.array([b.encode() for b in borders.value], object)
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            t = t.take(pc.sort_indices(t, [(c, "ascending") for c in ("at", "k", *sort)], null_placement="at_start"))
            t = t.filter(_last_of(t)).combine_chunks()
            k = np.array(t.column("k").cast(pa.binary()).to_pylist(), object)
            yield from t.append_column("range", pa.array(np.searchsorted(edge, k, side="right").astype(np.int32) if len(edge) else np.zeros(len(k), np.int32))).to_batches()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One file for each snapshot of the range; rows come sorted by snapshot, key and order."""
        target, folder = open_path(kept.folder)
        target.create_dir(folder, recursive=True)
        schema = pa.schema([("k", pa.string()), *((c, pa.string() if exact_columns else pa.binary()) for c in held)])
        at, writer, carry, done = None, None, None, []
        for b in batches:
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([carry, t]) if carry is not None else t
            carry, t = t.slice(t.num_rows - 1), t.slice(0, t.num_rows - 1)
            keep = _last_of(pa.concat_tables([t, carry]).combine_chunks())[: t.num_rows] if t.num_rows else None
            for part in _runs(t.filter(keep)) if keep is not None else ():
                at, writer = _to_file(part, at, writer, target, folder, schema, done)
        if carry is not None and carry.num_rows:
            at, writer = _to_file(carry, at, writer, target, folder, schema, done)
        if writer:
            writer.close()
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], k) for i, k in enumerate((pa.string(), pa.int32(), pa.string()))], names=["at", "range", "path"])

    thinned = tidy.mapInArrow(thin, T.StructType([*tidy.schema.fields, T.StructField("range", T.IntegerType())]))
    ranged = thinned.repartitionById(len(kept.borders) + 1, F.col("range")).sortWithinPartitions("at", "k", *sort)
    made = ranged.mapInArrow(write, "at string, range int, path string").collect()  # one row for each range and snapshot
    return Kept(kept.folder, kept.columns, kept.borders, kept.files | {(r["at"], r["range"]): posixpath.join(kept.folder, r["path"]) for r in made})


def _last_of(t: pa.Table) -> pa.Array:
    """Whether a row of a sorted table is the last of its snapshot and key."""
    n = t.num_rows
    if n < 2:
        return pa.array([True] * n, pa.bool_())
    k, at = t.column("k"), t.column("at")
    other = pc.or_(pc.not_equal(k.slice(1), k.slice(0, n - 1)), pc.not_equal(at.slice(1), at.slice(0, n - 1)))
    return pa.concat_arrays([*(other.chunks if isinstance(other, pa.ChunkedArray) else [other]), pa.array([True])])


def _runs(t: pa.Table) -> Iterator[pa.Table]:
    """A table sorted by snapshot, one snapshot at a time."""
    at = t.column("at").to_pylist()
    begin = 0
    for i in range(1, len(at) + 1):
        if i == len(at) or at[i] != at[begin]:
            yield t.slice(begin, i - begin)
            begin = i


def _to_file(part: pa.Table, at, writer, target, folder, schema, done):  # noqa: ANN001, ANN202
    tag = part.column("at")[0].as_py()
    if tag != at:
        if writer:
            writer.close()
        name = f"{uuid.uuid4().hex}.parquet"
        writer = pq.ParquetWriter(posixpath.join(folder, name), schema, filesystem=target, compression="zstd")
        done.append((tag, part.column("range")[0].as_py(), name))
    writer.write_table(part.select(schema.names).cast(schema))
    return tag, writer


class Pointer:
    """A sorted file read in slices, always with rows at hand until it ends."""

    def __init__(self, path: str | None):
        self.rest = iter(())
        if path is not None:
            source, name = open_path(path)
            self.rest = pq.ParquetFile(name, filesystem=source).iter_batches(ROWS)
        self.rows: pa.Table | None = None
        self.fill()

    def fill(self) -> None:
        while self.rows is None or not self.rows.num_rows:
            b = next(self.rest, None)
            if b is None:
                self.rows = None
                return
            self.rows = pa.Table.from_batches([b])

    def last(self) -> bytes:
        return self.rows.column("k")[-1].as_py().encode()

    def upto(self, bound: bytes) -> pa.Table:
        """Rows with keys not after ``bound``; the pointer moves past them."""
        k = self.rows.column("k")
        low, high = 0, len(k)
        while low < high:
            mid = (low + high) // 2
            low, high = (mid + 1, high) if k[mid].as_py().encode() <= bound else (low, mid)
        got, self.rows = self.rows.slice(0, low).combine_chunks(), self.rows.slice(low)
        self.fill()
        return got


def merged(before: str | None, after: str | None) -> Iterator[tuple[str, pa.Table, pa.Table | None]]:
    """Typed changes from one sorted file to another: (kind, rows, for changed ones also the rows before)."""
    a, b = Pointer(before), Pointer(after)
    while a.rows is not None and b.rows is not None:
        bound = min(a.last(), b.last())
        old, new = a.upto(bound), b.upto(bound)
        place = pc.index_in(new.column("k"), value_set=old.column("k").combine_chunks())
        still = pc.index_in(old.column("k"), value_set=new.column("k").combine_chunks())
        yield "removed", old.filter(pc.is_null(still)), None
        yield "added", new.filter(pc.is_null(place)), None
        both = new.filter(pc.is_valid(place))
        match = old.take(place.drop_null())
        differs = None
        for c in new.column_names[1:]:
            d = pc.not_equal(both.column(c), match.column(c))
            differs = d if differs is None else pc.or_(differs, d)
        if differs is not None:
            yield "changed", both.filter(differs), match.filter(differs)
    for pointer, kind in ((a, "removed"), (b, "added")):
        while pointer.rows is not None:
            yield kind, pointer.upto(pointer.last()), None


def kept_changes(spark: SparkSession, kept: Kept, snapshot: str, key: str, pairs: list[tuple[str, str]], with_columns: bool) -> DataFrame:
    """Changes between pairs of kept snapshots, one task for each pair and range; nothing is shuffled."""
    work = [(b, kept.files.get((a, i)), kept.files.get((b, i))) for a, b in pairs for i in range(len(kept.borders) + 1)]
    work = [w for w in work if w[1] or w[2]]
    schema = f"`{snapshot}` string, `{key}` string, change_kind string" + ", changed_columns array<string>" * with_columns
    columns = kept.columns

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in batch.to_pylist():
                for kind, rows, old in merged(w["before"], w["after"]):
                    n = rows.num_rows
                    if not n:
                        continue
                    arrays = [pa.array([w["at"]] * n, pa.string()), pa.concat_arrays(rows.column("k").chunks), pa.array([kind] * n, pa.string())]
                    if with_columns:
                        diff = [None] * n
                        if old is not None:
                            each = [pc.not_equal(rows.column(f"c{i}"), old.column(f"c{i}")).to_pylist() for i in range(len(columns))]
                            diff = [[c for c, d in zip(columns, row) if d] for row in zip(*each)]
                        arrays.append(pa.array(diff, pa.list_(pa.string())))
                    yield pa.RecordBatch.from_arrays(arrays, names=[snapshot, key, "change_kind", *["changed_columns"] * with_columns])

    tasks = spark.createDataFrame([(i, *w) for i, w in enumerate(work)], "task int, at string, before string, after string")
    return tasks.repartitionById(max(len(work), 1), F.col("task")).mapInArrow(compare, schema)


def snapshot_changes(df: DataFrame, snapshot: str, key: str, columns: list[str], order: tuple[str, ...] = (), with_columns: bool = True) -> DataFrame:
    """Records added, removed or changed from each snapshot to the next.

    Result: ``snapshot`` (for a removal the first snapshot without the record), ``key``,
    ``change_kind`` (``added``, ``removed``, ``changed``) and, with ``with_columns``,
    ``changed_columns``. Snapshots follow each other in text order; the first one gives no rows. Keys
    and values are compared as text without surrounding white space, null as empty; records whose key
    or snapshot is empty are left out. Of several records with one key in one snapshot the greatest by
    ``order`` and then by content counts. A key that goes and comes back is removed, then added. An empty
    table gives no rows. Other columns are not read. With ``with_columns`` the kept files hold the columns
    and these are compared; without it they hold a digest of 128 bits of each record's columns, so that
    less is moved. The files are kept in the shared folder; ``keep_snapshots`` and ``kept_changes`` do the
    same for one new snapshot at a time.
    """
    kept = keep_snapshots(df, snapshot, key, columns, order, exact_columns=with_columns)
    names = kept.snapshots()
    return kept_changes(df.sparkSession, kept, snapshot, key, list(zip(names, names[1:])), with_columns)
