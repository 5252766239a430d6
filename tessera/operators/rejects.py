"""Rows that fail to parse: structural indexing of delimited records.

The bytes of a whole Arrow batch are indexed at once with numpy. A quote mask and the parity of its
prefix sum, taken anew in each record, tell which delimiters stand outside quotes; those give the
fields. Form checks and value checks are masks over the fields of all records; only values that no mask
settles are looked at one by one. They make each record a valid row or a reject with its reason. Nothing
is shuffled: records are judged where they are read. Whole files are cut into records the same way: blocks
of a file count their quotes, and the parity of the quotes before a block tells which of its line breaks end
a record.
"""

from __future__ import annotations

import posixpath
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import open_path

QUOTE, DELIMITER, RETURN, NEWLINE = 0x22, 0x3B, 0x0D, 0x0A

# The staging columns in file order, all text.
STAGING_COLUMNS = [
    "county_code", "county_name", "oevk_code", "settlement_code", "settlement_name", "tevk_code",
    "polling_station_code", "polling_station_address", "counting_designated", "accessible",
    "postal_code", "street_name", "street_type", "house_number", "building", "staircase",
    "gate_code", "additional_info",
]
STREET, HOUSE = STAGING_COLUMNS.index("street_name"), STAGING_COLUMNS.index("house_number")

REASONS = ["quoting", "column_count", "invalid_value"]  # the first that applies
HOUSE_NUMBER = re.compile(r"([0-9]{1,6}(-[0-9]{1,6})?(/[^\W_]{1,4})?)?")
_PLAIN = "A-Za-zÁÉÍÓÖŐÚÜŰáéíóöőúüűÄäß"
PLAIN_STREET = rf"""^[{_PLAIN}0-9 .,\-'"()/]*[{_PLAIN}][{_PLAIN}0-9 .,\-'"()/]*$"""
PLAIN_NAME = re.compile(PLAIN_STREET[1:-1])
# Written-out nulls and error marks, without case, brackets and surrounding signs.
NULL_WORDS = {"null", "none", "nil", "nan", "undefined", "(null)", "<null>", "[null]", "\\n", "n/a", "#n/a", "#na", "na", "missing", "unknown"}
ERROR_MARK = re.compile(r"#[A-Za-z0-9/]+[!?]?|err(or)?:?\s*\d*|#?hiv!|#?név\?|#?érték!|#?hiány", re.I)
# Letters of one single-byte set that appear where Hungarian letters of another were meant.
WRONG_LETTERS = re.compile("[õûÕÛþÞðÐ]")
# Signs that words do not hold, but that wrongly decoded bytes turn into.
WRONG_SIGNS = re.compile(r"\w[¡-¿×÷‚ƒ„…†‡ˆ‰‹Œ‘’“”•–—˜™›œ¨´¸˝˛ˇ˘]\w|[ÃÂÄÅĂĹ][\u0080-¿‚ƒ„…†‡ˆ‰‹Œ‘’“”•–—˜™›œšžŸ€±ˇ©­]")


def wrongly_decoded(text: str) -> bool:
    """Whether the text is what bytes of one character set give when read as another."""
    if text.isascii():
        return False
    if WRONG_LETTERS.search(text) or WRONG_SIGNS.search(text):
        return True
    for code in ("latin-1", "cp1252", "cp1250", "iso8859-2"):
        try:
            back = text.encode(code).decode("utf-8")
        except UnicodeError:
            continue
        if back != text:
            return True
    return False


def bad_street_name(text: str) -> bool:
    """Whether a public-space name is unusable."""
    if PLAIN_NAME.fullmatch(text) and text.strip().lower() not in NULL_WORDS:
        return False
    if not any(unicodedata.category(c)[0] == "L" for c in text):
        return True
    if any(c == "�" or unicodedata.category(c) in ("Cc", "Cf", "Co", "Cs", "Cn") for c in text):
        return True
    core = text.strip()
    return core.lower() in NULL_WORDS or bool(ERROR_MARK.fullmatch(core)) or wrongly_decoded(text)


def structural_index(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Field bounds of records that lie in one byte buffer, and which records are badly quoted.

    Returns ``(field_starts, field_ends, first_field, bad)``: fields of record ``i`` are
    ``first_field[i]:first_field[i + 1]``; ``bad[i]`` tells of a quoting error.
    """
    n = len(starts)
    ends = ends - ((ends > starts) & (data[np.maximum(ends - 1, 0)] == RETURN) if len(data) else 0)
    quotes = np.flatnonzero(data == QUOTE)
    delimiters = np.flatnonzero(data == DELIMITER)
    # Prefix parity: quotes before a delimiter, counted from its record's start.
    record_of = np.searchsorted(starts, delimiters, side="right") - 1
    inside = (delimiters < ends[record_of]) if n else np.zeros(0, bool)
    delimiters, record_of = delimiters[inside], record_of[inside]
    before = np.searchsorted(quotes, delimiters) - np.searchsorted(quotes, starts[record_of])
    outside = before % 2 == 0
    delimiters, record_of = delimiters[outside], record_of[outside]
    per_record = np.bincount(record_of, minlength=n) + 1
    first = np.concatenate([[0], np.cumsum(per_record)])
    total = int(first[-1])
    f_start, f_end = np.empty(total, np.int64), np.empty(total, np.int64)
    is_last = np.zeros(total, bool)
    is_last[first[1:] - 1] = True
    is_first = np.zeros(total, bool)
    is_first[first[:-1]] = True
    f_end[is_last], f_end[~is_last] = ends, delimiters
    f_start[is_first], f_start[~is_first] = starts, delimiters + 1

    padded = np.append(data, 0)
    filled = f_end > f_start
    opens = filled & (padded[np.minimum(f_start, len(data))] == QUOTE)
    closes = filled & (padded[np.maximum(f_end - 1, 0)] == QUOTE)
    q_first, q_last = np.searchsorted(quotes, f_start), np.searchsorted(quotes, f_end)
    count = q_last - q_first
    bad_field = (~opens & (count > 0)) | (opens & (~closes | (count < 2) | (count % 2 == 1)))
    # Quotes between the outer two must stand in adjacent pairs: the 2nd and 3rd, the 4th and 5th, ...
    check = np.flatnonzero(opens & (count > 2) & ~bad_field)
    if len(check):
        pairs = (count[check] - 2) // 2
        nth = np.arange(pairs.sum()) - np.repeat(np.cumsum(pairs) - pairs, pairs)
        left = np.repeat(q_first[check] + 1, pairs) + 2 * nth
        bad_field[np.repeat(check, pairs)[quotes[left + 1] - quotes[left] != 1]] = True
    field_record = np.repeat(np.arange(n), per_record)
    bad = np.bincount(field_record[bad_field], minlength=n) > 0
    return f_start, f_end, first, bad


def record_ends(data: np.ndarray, inside: int = 0) -> np.ndarray:
    """Positions of the line breaks of a file's bytes that stand outside quotes, hence end a record; ``inside``: whether the bytes begin within quotes."""
    quotes, breaks = np.flatnonzero(data == QUOTE), np.flatnonzero(data == NEWLINE)
    return breaks[np.searchsorted(quotes, breaks) % 2 == inside]


def field_texts(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Fields as texts, without outer quotes and with inner ones single; bytes that are no UTF-8 become replacement characters."""
    quoted = (end > start) & (data[np.minimum(start, len(data) - 1)] == QUOTE) if len(data) else np.zeros(len(start), bool)
    start, end = start + quoted, end - quoted
    size = end - start
    offsets = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])
    raw = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[at]))])
    try:
        text = raw.cast(pa.large_string())
    except pa.ArrowInvalid:
        text = pa.array([b.decode("utf-8", "replace") for b in raw.to_pylist()], pa.large_string())
    return pc.replace_substring(text, '""', '"').cast(pa.string())


def bad_values(house: pa.Array, street: pa.Array) -> np.ndarray:
    """Which rows have an unusable house number or public-space name; patterns settle nearly all, the rest is looked at one by one."""
    number = pc.utf8_trim_whitespace(house)
    plain = pc.match_substring_regex(number, r"^([0-9]{1,6}(-[0-9]{1,6})?(/[0-9A-Za-z]{1,4})?)?$")
    bad = np.zeros(len(house), bool)
    rest = np.flatnonzero(~plain.to_numpy(zero_copy_only=False).astype(bool))
    bad[rest] = [not HOUSE_NUMBER.fullmatch(h.strip()) for h in number.take(pa.array(rest)).to_pylist()]
    fine = pc.and_(pc.match_substring_regex(street, PLAIN_STREET), pc.invert(pc.is_in(pc.utf8_lower(pc.utf8_trim_whitespace(street)), value_set=pa.array(sorted(NULL_WORDS)))))
    rest = np.flatnonzero(~fine.to_numpy(zero_copy_only=False).astype(bool) & ~bad)
    bad[rest] = [bad_street_name(s) for s in street.take(pa.array(rest)).to_pylist()]
    return bad


def _judge(column: pa.Array, width: int, with_fields: bool) -> tuple[pa.Array, list[pa.Array]]:
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    column = column.fill_null("")
    n = len(column)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int32, n + 1, column.offset * 4).astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    base = offsets[0]
    data, offsets = data[base : offsets[-1]], offsets - base
    f_start, f_end, first, bad = structural_index(data, offsets[:-1], offsets[1:])
    reason = np.full(n, 3, np.int8)
    reason[np.diff(first) != width] = 1
    reason[bad] = 0
    whole = np.flatnonzero(reason == 3)
    field = lambda j, rows: field_texts(data, f_start[first[rows] + j], f_end[first[rows] + j])
    reason[whole[bad_values(field(HOUSE, whole), field(STREET, whole))]] = 2
    reasons = pa.DictionaryArray.from_arrays(pa.array(reason, mask=reason == 3), pa.array(REASONS)).cast(pa.string())
    if not with_fields:
        return reasons, []
    sound = np.flatnonzero(reason == 3)
    place = np.full(n, -1, np.int64)
    place[sound] = np.arange(len(sound))
    place = pa.array(place, mask=place < 0)
    return reasons, [field(j, sound).take(place) for j in range(width)]


def parse_records(df: DataFrame, record: str = "raw_record", keep: tuple[str, ...] = ("record_id",), with_fields: bool = True) -> DataFrame:
    """Split records into staging columns or a reason for failure.

    Every input row gives one output row: the ``keep`` columns, ``reason`` (null if the record is
    sound; ``quoting``, ``column_count`` or ``invalid_value`` otherwise, the first that applies) and,
    with ``with_fields``, the staging columns (null where there is a reason). A null or empty record
    has one empty field and so fails with ``column_count``; one carriage return at the end does not
    count; repeated rows are judged each; an empty table gives an empty table. Columns of the input
    other than ``keep`` are left out, so names like those of the staging columns do not clash; a
    ``keep`` name that equals an output column raises ``ValueError``.
    """
    made = ["reason", *(STAGING_COLUMNS if with_fields else [])]
    if clash := set(keep) & set(made):
        raise ValueError(f"columns made by the parser: {sorted(clash)}")
    schema = T.StructType([*(df.schema[c] for c in keep), *(T.StructField(c, T.StringType()) for c in made)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            reasons, fields = _judge(b.column(len(keep)), len(STAGING_COLUMNS), with_fields)
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), reasons, *fields], names=[*keep, *made])

    return df.select(*keep, df[record].cast("string").alias("__record")).mapInArrow(run, schema)


def read_records(spark: SparkSession, paths: list[str], block_bytes: int = 64 << 20) -> DataFrame:
    """Records of delimited files: ``file_name``, ``line_no`` (the first record is 1), ``raw_record``.

    A record ends at a line break outside quotes, so it may hold line breaks itself; a byte-order mark and the line
    break are not part of it, empty lines are left out but counted. Files are read in blocks, by as many tasks: the
    blocks' quotes are counted first, then each block gives the records that begin in it and reads on to the end of
    the last. A quote that is never closed makes the rest of its file one record; ``parse_records`` then tells. The
    driver holds two numbers for each block.
    """
    blocks = []
    for path in paths:
        source, name = open_path(path)
        size = source.get_file_info(name).size
        blocks += [(path, at, min(block_bytes, size - at)) for at in range(0, size, block_bytes)]
    tasks = [(i, *b) for i, b in enumerate(blocks)]
    schema = "block int, path string, at long, size long"

    def read(path: str, at: int, size: int) -> np.ndarray:
        source, name = open_path(path)
        with source.open_input_file(name) as f:
            return np.frombuffer(f.read_at(size, at), np.uint8)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in b.to_pylist():
                data = read(t["path"], t["at"], t["size"])
                quotes, breaks = np.cumsum(data == QUOTE) % 2, data == NEWLINE
                # Breaks outside quotes if the block begins outside, and if it begins inside.
                n = [int((breaks & (quotes == inside)).sum()) for inside in (0, 1)]
                yield pa.RecordBatch.from_pydict({"block": pa.array([t["block"]], pa.int32()), "odd": pa.array([int(quotes[-1])], pa.int32()), "plain": [n[0]], "quoted": [n[1]]})

    if not tasks:
        return spark.createDataFrame([], "file_name string, line_no long, raw_record string")
    spread = spark.createDataFrame(tasks, schema).repartitionById(len(tasks), F.col("block"))
    counted = {r["block"]: r for r in spread.mapInArrow(count, "block int, odd int, plain long, quoted long").collect()}
    work, inside, lines, before = [], 0, 0, None
    for i, path, at, size in tasks:
        if path != before:
            inside, lines, before = 0, 0, path
        work.append((i, path, at, size, inside, lines))
        lines += counted[i]["quoted" if inside else "plain"]
        inside ^= counted[i]["odd"]

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in b.to_pylist():
                data = read(t["path"], t["at"], t["size"])
                ends = record_ends(data, t["inside"])
                tail = data[ends[-1] + 1 :] if len(ends) else data
                fresh = t["at"] == 0 or (not t["inside"] and read(t["path"], t["at"] - 1, 1)[0] == NEWLINE)
                if not fresh and not len(ends):
                    continue  # the record of an earlier block goes on
                # Read on to the end of the last record that begins here.
                parity, at, more = (int((data == QUOTE).sum()) + t["inside"]) % 2, t["at"] + t["size"], []
                while len(tail) and (next_ := read(t["path"], at, block_bytes)).size:
                    stop = record_ends(next_, parity)
                    more.append(next_[: stop[0]] if len(stop) else next_)
                    if len(stop):
                        break
                    parity, at = (parity + int((next_ == QUOTE).sum())) % 2, at + len(next_)
                begins = np.concatenate([[0], ends + 1])
                stops = np.append(ends, len(data))
                records = [data[x:y].tobytes() for x, y in zip(begins[:-1], stops[:-1])] + [tail.tobytes() + b"".join(m.tobytes() for m in more)]
                if not fresh:
                    records[0] = b""  # the end of a record that began before
                elif t["at"] == 0:
                    records[0] = records[0].removeprefix("\ufeff".encode())
                held = [(k, r) for k, r in enumerate(records) if r]
                yield pa.RecordBatch.from_pydict({"file_name": pa.array([posixpath.basename(t["path"])] * len(held), pa.string()), "line_no": pa.array([t["lines"] + k + 1 for k, _ in held], pa.int64()), "raw_record": pa.array([r.decode("utf-8", "replace") for _, r in held], pa.string())})

    return spark.createDataFrame(work, schema + ", inside int, lines long").repartitionById(len(work), F.col("block")).mapInArrow(cut_up, "file_name string, line_no long, raw_record string")
