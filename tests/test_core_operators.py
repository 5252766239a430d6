"""Core operators on small tables: empty, null, repeated, tied and clashing input."""

import datetime as dt
import hashlib
import math
import random

import pytest

from pyspark.sql import functions as F

from tessera.functions.textops import duration_text
from tessera.operators.export import chosen_settlements, closed_subset
from tessera.operators.geocode import answer_place, best_fuzzy, better_wins, interpolate, quality_by_keyword, station_places, wants_retry
from tessera.operators.orphans import Reference, compress, expand, orphans
from tessera.operators.proximity import cover, edges, even_odd, near_pairs, nearest, parse_polygon, points_within, regions_of, regions_overlap
from tessera.operators.rejects import STAGING_COLUMNS, parse_records, read_records, record_ends
from tessera.operators.snapshots import keep_snapshots, kept_changes, snapshot_changes
from tessera.session import WHITE, strip
from tessera.operators.tables import add_column, check_input, columns_of, count_distinct_with_null, deterministic_sample, differences, keep_first, last_wins, merge_columns, parents, running_count, verify_counts, with_sequence

D = lambda d, h=0: dt.datetime(2025, 7, d, h)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_strip(spark):
    texts = ["a", " a ", "\u00a0Á\u3000", "\ufeffá b\x1c", "", " ", None, "ﬀ ", "中", " 中", "\x7fa", "\u200b"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    assert [r.y for r in df.select("i", strip("x").alias("y")).orderBy("i").collect()] == [x.strip(WHITE) if x is not None else None for x in texts]


# References


def test_bitmaps_round_trip():
    import numpy as np

    for n in (0, 1, 100, 5000, 32768):
        bits = np.zeros(1 << 15, bool)
        bits[random.Random(n).sample(range(1 << 15), n)] = True
        raw = np.packbits(bits, bitorder="little").tobytes()
        assert np.asarray(expand(compress(raw))).tobytes() == raw
        assert len(compress(raw)) <= 4097
    assert not np.asarray(expand(None)).any()


def refs(spark, child, parent, **kw):
    c = spark.createDataFrame(child, "id string, ref string, t timestamp, key string, code long")
    p = spark.createDataFrame(parent, "id string, loaded_at timestamp, deleted_at timestamp, month string")
    return orphans([Reference("child", c, "id", "ref", "t", p, target_to="deleted_at")], **kw)


def test_orphans_at_their_own_time(spark):
    parent = [("a", D(10), None, "x"), ("b", D(1), D(20), "x"), ("b", D(25), None, "x"), ("c", None, None, "x"), (None, D(1), None, "x")]
    child = [
        ("1", "a", D(9), "k", 1), ("2", "a", D(10), "k", 1), ("3", " A\t", D(11), "k", 1), ("4", "b", D(19), "k", 1), ("5", "b", D(20), "k", 1),
        ("6", "b", D(26), "k", 1), ("7", "zz", D(1), "k", 1), ("8", None, D(1), "k", 1), ("9", "  ", D(1), "k", 1), ("10", "c", D(5), "k", 1),
        ("11", "zz", None, "k", 1), ("7", "zz", D(1), "k", 1), ("2", "a", dt.datetime(2025, 6, 1), "k", 1),
    ]
    assert rows(refs(spark, child, parent)) == [("child", "2025-06", "2"), ("child", "2025-07", "1"), ("child", "2025-07", "10"), ("child", "2025-07", "5"), ("child", "2025-07", "7")]


def test_orphans_of_empty_tables(spark):
    assert rows(refs(spark, [], [("a", D(1), None, "x")])) == []
    assert rows(refs(spark, [("1", "a", D(9), "k", 1)], [])) == [("child", "2025-07", "1")]


def test_orphans_against_brute_force(spark):
    r = random.Random(5)
    day = lambda: dt.datetime(2025, 1, 1) + dt.timedelta(hours=r.randrange(24 * 200))
    parent = []
    for _ in range(200):
        a = day()
        parent.append((f"k{r.randrange(60)}", a, r.choice([None, a + dt.timedelta(days=r.randrange(-3, 80))]), ""))
    child = [(str(i), "k1" if r.random() < 0.3 else f"k{r.randrange(80)}", day(), "", 0) for i in range(600)]
    want = sorted({("child", t.strftime("%Y-%m"), i) for i, k, t, _, _ in child if not any(p == k and a <= t and (b is None or b > t) for p, a, b, _ in parent)})
    assert rows(refs(spark, child, parent)) == want
    assert rows(refs(spark, child, parent, hot_rows=5)) == want  # hot keys dealt to several tasks


def test_orphans_of_far_dates(spark):
    # The work depends on the rows, not on the months between their dates.
    parent = [(f"k{i}", D(1), None if i % 2 else dt.datetime(9990, 3, 1), "") for i in range(2000)]
    child = [("1", "k1", dt.datetime(9990, 2, 2), "", 0), ("2", "k2", dt.datetime(9990, 2, 2), "", 0), ("3", "k2", dt.datetime(9990, 3, 2), "", 0), ("4", "k3", dt.datetime(1, 1, 2), "", 0)]
    assert rows(refs(spark, child, parent)) == [("child", "0001-01", "4"), ("child", "9990-03", "3")]


# Snapshots


def changes(spark, data, **kw):
    df = spark.createDataFrame(data, "run string, key string, a string, b string, at int, change_kind string, content string")
    return rows(snapshot_changes(df, "run", "key", ["a", "b"], ("at",), **kw))


def test_snapshot_changes(spark):
    data = [
        ("1", "k1", "x", "y", 1, "", ""), ("2", " k1 ", " x", "y ", 1, "", ""), ("3", "k1", "x", "z", 1, "", ""),
        ("1", "k2", None, "", 1, "", ""), ("2", "k2", "", None, 1, "", ""),
        ("1", "k3", "x", "y", 1, "", ""), ("3", "k3", "x", "y", 1, "", ""),
        ("2", "k4", "x", "y", 1, "", ""), ("2", "k4", "new", "y", 2, "", ""), ("3", "k4", "new", "y", 1, "", ""),
        ("1", None, "x", "y", 1, "", ""), ("2", " ", "x", "y", 1, "", ""), (None, "k9", "x", "y", 1, "", ""),
    ]
    got = changes(spark, data)
    assert [(a, b, c, tuple(d) if d else None) for a, b, c, d in got] == [
        ("2", "k3", "removed", None), ("2", "k4", "added", None), ("3", "k1", "changed", ("b",)), ("3", "k2", "removed", None), ("3", "k3", "added", None)]
    assert changes(spark, []) == []
    assert changes(spark, data[:1], with_columns=False) == []


def test_snapshot_changes_against_brute_force(spark):
    r = random.Random(1)
    data = [(str(run), f"k{r.randrange(400)}" if r.random() < 0.7 else "hot", r.choice("xy"), r.choice("pq"), i, "", "") for run in range(4) for i in range(500)]
    state = [{} for _ in range(4)]
    for run, k, a, b, at, _, _ in data:
        state[int(run)][k] = max(state[int(run)].get(k, (-1,)), (at, f"{a}\u001f{b}"))
    want = []
    for n in range(1, 4):
        for k in state[n - 1].keys() | state[n].keys():
            x, y = state[n - 1].get(k), state[n].get(k)
            kind = "added" if x is None else "removed" if y is None else "changed" if x[1] != y[1] else None
            want += [(str(n), k, kind)] if kind else []
    assert changes(spark, data, with_columns=False) == sorted(want)


def test_a_new_snapshot_moves_only_itself(spark):
    schema = "run string, key string, a string, at int"
    first = spark.createDataFrame([("1", f"k{i:03d}", "a b", 1) for i in range(300)], schema)
    second = spark.createDataFrame([("2", f"k{i:03d}", "a\x1fb" if i == 7 else "a c" if i == 8 else "a b", 1) for i in range(1, 302)], schema)
    for exact in (True, False):
        kept = keep_snapshots(first, "run", "key", ["a"], ("at",), exact, ranges=5)
        files = dict(kept.files)
        kept = keep_snapshots(second, "run", "key", ["a"], ("at",), exact, kept=kept)
        assert len(kept.borders) == 4 and len(kept.files) == 10 and files.items() <= kept.files.items() and kept.snapshots() == ["1", "2"]
        got = rows(kept_changes(spark, kept, "run", "key", [("1", "2")], False))
        assert got == [("2", "k000", "removed"), ("2", "k007", "changed"), ("2", "k008", "changed"), ("2", "k300", "added"), ("2", "k301", "added")]


# Proximity


def test_cover_agrees_with_even_odd():
    import numpy as np

    r = random.Random(3)
    for n in range(6):
        star = np.array([(47 + math.cos(k) * (0.1 + 0.4 * r.random()), 19 + math.sin(k) * (0.1 + 0.4 * r.random())) for k in np.linspace(0, 6.2, 25)])
        if n == 5:
            star = np.array([(47 + math.cos(k) * (0.4 + 0.1 * r.random()), 19 + math.sin(k) * (0.4 + 0.1 * r.random())) for k in np.linspace(0, 6.2, 30)])
        elif n:
            star = np.round(star, 2)  # many points on cell borders and equal latitudes
        cells = {(lv, a, b): x for lv, a, b, *x in cover(star)}
        levels = {lv for lv, _, _ in cells}
        inner = tested = 0
        ys, xs = [47 + r.uniform(-0.6, 0.6) for _ in range(600)], [19 + r.uniform(-0.6, 0.6) for _ in range(600)]
        ys, xs = ys + star[:, 0].tolist() + [round(y, 2) for y in ys], xs + star[:, 1].tolist() + [round(x, 2) for x in xs]
        for y, x, want in zip(ys, xs, even_odd(edges(star), np.array(ys), np.array(xs))):
            met = [c for lv in levels if (c := cells.get((lv, math.floor((y + 90) * (2**lv / 360)), math.floor((x + 180) * (2**lv / 360)))))]
            assert len(met) <= 1
            got = False
            for lines, odd, changes in met:
                got = lines is None or bool(even_odd(lines, np.array([y]), np.array([x]))[0] ^ odd ^ ((changes <= y).sum() % 2 == 1))
                inner, tested = inner + (lines is None), tested + (lines is not None)
            assert got == want, (y, x)
    assert inner > 0.8 * (inner + tested)
    assert max(len(x[0]) for x in cells.values() if x[0] is not None) < 10


def test_polygons_as_they_come():
    assert parse_polygon(None) is None and parse_polygon("1 2,3 4") is None
    assert parse_polygon(" 1  2 ,x y,3 4, 5 ,6 7,nan 1").tolist() == [[1, 2], [3, 4], [6, 7]]


def test_regions(spark):
    pts = spark.createDataFrame([("a", 1.0, 1.0, "q"), ("b", 5.0, 1.0, "q"), ("c", None, 1.0, "q"), ("d", 0.0, 0.0, "q"), ("a", 1.0, 1.0, "q"), (None, 1.0, 1.0, "q")], "k string, lat double, lon double, region_id string")
    reg = spark.createDataFrame([("r1", "0 0,0 2,2 2,2 0"), ("r2", "0.5 0.5,0.5 3,3 3,3 0.5,0.5 0.5"), ("r3", "0 0,1 1"), ("r4", None), ("r1", "0 0,0 2,2 2,2 0")], "id string, poly string")
    assert rows(regions_of(pts, reg, "k", "lat", "lon", "id", "poly")) == [("a", "r1"), ("a", "r2")]
    assert rows(regions_of(pts, reg, "k", "lat", "lon", "id", "poly", broadcast_bytes=0)) == [("a", "r1"), ("a", "r2")]
    assert rows(regions_of(pts.limit(0), reg, "k", "lat", "lon", "id", "poly")) == []
    assert rows(regions_of(pts, reg.limit(0), "k", "lat", "lon", "id", "poly")) == []


def test_near_pairs_against_brute_force(spark):
    r = random.Random(2)
    base = [(47.0, 19.0), (0.0, 179.99999), (-45.0, -180.0), (89.9999, 10.0), (60.0, 0.0), (-89.99995, 100.0)]
    pts = []
    for i in range(500):
        y, x = base[i % len(base)]
        s = 0.0004
        x = x + r.uniform(-s, s) / max(math.cos(math.radians(y)), 1e-4)
        pts.append((f"k{i:03d}", max(-90.0, min(90.0, y + r.uniform(-s, s) * 0.4)), (x + 180) % 360 - 180))
    pts += [("dup1", 47.0, 19.0), ("dup2", 47.0, 19.0), ("dup1", 47.0, 19.0), ("bad", 95.0, 1.0), ("nul", None, 1.0), ("zero", 0.0, 0.0), (None, 47.0, 19.0)]

    def metres(a, b):
        p, q = math.radians(a[1]), math.radians(b[1])
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
        return 2 * 6371000 * math.asin(min(1, math.sqrt(h)))

    ok = sorted({p for p in pts if p[0] and p[1] is not None and abs(p[1]) <= 90 and p[0] not in ("zero",)})
    want = sorted((a[0], b[0]) for i, a in enumerate(ok) for b in ok[i + 1 :] if metres(a, b) <= 15)
    df = spark.createDataFrame(pts, "k string, lat double, lon double")
    assert len(want) > 100 and rows(near_pairs(df, "k", "lat", "lon", 15.0)) == want
    assert rows(near_pairs(df.limit(0), "k", "lat", "lon", 15.0)) == []


# Records


def record(house='"000001"', street='"Anna"', n=17, tail=""):
    f = ['"01"'] * n
    f[11], f[13] = street, house
    return ";".join(f) + ";" + tail


RECORDS = [
    (record(), None), (record() + "\r", None), (record(tail='"a; ""b"""'), None), (record(street='"An""na"""'), None), (record().replace('"', ""), None), (record(street='"An; na"').replace('"01"', '"0\n1"', 1), None), (record(street='"An\nna"'), "invalid_value"),
    (record(house='""'), None), (record(house='" 000001-00005/D "'), None), (record(street='An"na'), "quoting"), (record(street='"Anna'), "quoting"), (record(street='"An"na"'), "quoting"), (record(street='Anna"'), "quoting"),
    (record(n=16), "column_count"), (record(n=18), "column_count"), ("", "column_count"), (None, "column_count"), (" ", "column_count"), (record(house='"1//A"'), "invalid_value"), (record(house='"0000001"'), "invalid_value"), (record(house='"１"'), "invalid_value"),
    (record(street='""'), "invalid_value"), (record(street='"NULL"'), "invalid_value"), (record(street='"#REF!"'), "invalid_value"), (record(street='"FehÃ©r"'), "invalid_value"), (record(street='"Felsõ"'), "invalid_value"), (record(street='"A​nna"'), "invalid_value"), (record(street='"An�na"'), "invalid_value"), (record(street='"Őszirózsa"'), None),
]


def test_records(spark):
    df = spark.createDataFrame([(i, r, "x", "y") for i, (r, _) in enumerate(RECORDS)], "record_id long, raw_record string, reason string, street_name string")
    got = parse_records(df)
    assert got.columns == ["record_id", "reason", *STAGING_COLUMNS]
    by = {r.record_id: r for r in got.collect()}
    assert [by[i].reason for i in range(len(RECORDS))] == [w for _, w in RECORDS]
    assert by[2].additional_info == 'a; "b"' and by[3].street_name == 'An"na"' and by[9].street_name is None
    assert parse_records(df.limit(0), with_fields=False).count() == 0
    with pytest.raises(ValueError):
        parse_records(df, keep=("reason",))


def test_record_ends():
    import numpy as np

    data = np.frombuffer(b'"a\nb";c\nd;"e"\n', np.uint8)
    assert record_ends(data).tolist() == [7, 13]


def test_files_are_cut_into_records(spark, tmp_path):
    r = random.Random(6)
    wanted, paths = [], []
    for f in range(4):
        fields = lambda: ";".join(f'"{"".join(r.choice("ab;\n") for _ in range(r.randrange(6)))}"' if r.random() < 0.4 else "é" * r.randrange(4) for _ in range(3))
        lines = [fields() + ";" for _ in range(30)] + [""] + ['"' + "x" * 300 + '\n";']
        text = "\n".join(lines) + ("\n" if f % 2 else "")
        (tmp_path / f"f{f}.csv").write_bytes(b"\xef\xbb\xbf" * (f == 2) + text.encode())
        paths.append(str(tmp_path / f"f{f}.csv"))
        wanted += [(f"f{f}.csv", i + 1, x) for i, x in enumerate(lines) if x]
    (tmp_path / "none.csv").write_bytes(b"")
    for size in (17, 100, 1 << 20):
        assert rows(read_records(spark, [*paths, str(tmp_path / "none.csv")], size)) == sorted(wanted)
    assert read_records(spark, []).count() == 0
    got = parse_records(read_records(spark, paths).withColumnRenamed("line_no", "record_id"), with_fields=False)
    assert {x.reason for x in got.collect()} == {"column_count"}


# Relational blocks


def test_upserts(spark):
    old = spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], "k string, v int, o int")
    new = spark.createDataFrame([("b", 2, 2), ("c", 3, 2), ("c", 4, 3), ("a", 9, 0)], "k string, v int, o int")
    assert rows(keep_first(old, new, ["k"], [F.col("o")])) == [("a", 1, 1), ("b", 1, 1), ("c", 3, 2)]
    assert rows(last_wins(old, new, ["k"], ["o"]).select("k", "v", "o")) == [("a", 9, 0), ("b", 2, 2), ("c", 4, 3)]
    assert rows(keep_first(old.limit(0), new.limit(0), ["k"], [F.col("o")])) == []


def test_partial_update_by_another_key(spark):
    old = spark.createDataFrame([(1, "a", "x", "I"), (2, "b", "y", None)], "id int, k string, v string, flag string")
    new = spark.createDataFrame([("a", None, "N"), ("c", "z", "I")], "k string, v string, flag string")
    assert sorted(map(str, rows_any(merge_columns(old, new, ["k"], ["v", "flag"])))) == sorted(map(str, [(1, "a", "x", "N"), (2, "b", "y", None), (None, "c", "z", "I")]))
    assert rows(merge_columns(old.limit(0), new.limit(0), ["k"], ["v"])) == []


def test_small_blocks(spark):
    df = spark.createDataFrame([("a", None), ("a", "x"), ("b", None)], "k string, v string")
    assert add_column(df, "v", F.lit("new")) is df and add_column(df, "w", F.lit(1)).columns == ["k", "v", "w"]
    assert rows(df.groupBy("k").agg(count_distinct_with_null(F.col("v")))) == [("a", 2), ("b", 1)]
    assert rows(running_count(df.where("v IS NULL"), ["k"], ["v"]).select("k", "nth")) == [("a", 1), ("b", 1)]
    assert columns_of({"t": df}) == [("t", 1, "k", "string"), ("t", 2, "v", "string")]
    assert check_input(df, ["k", "v"]) == {"k": 0, "v": 2}
    for bad in (lambda: check_input(df, ["gone"]), lambda: check_input(df.limit(0), ["k"])):
        with pytest.raises(ValueError):
            bad()
    got = verify_counts({"a": df, "b": df}, {"a": df.limit(2), "b": df.limit(2)}, {"b": 0})
    assert rows(got) == [("a", 3, 2, True), ("b", 3, 2, False)]
    assert rows(parents(spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 1)], "k string, p int"), "k", "p")) == [("a", 2)]
    d = spark.createDataFrame([(d,) for d in (5.0, 59.96, 90.0, 7200.0)], "s double")
    assert [r[0] for r in d.select(duration_text(F.col("s"))).collect()] == ["5.0s", "60.0s", "1.5m", "2.0h"]


def test_sample_is_exact(spark):
    df = spark.range(3000).selectExpr("CAST(id AS STRING) AS k")
    got = sorted(r.k for r in deterministic_sample(df, "k", 5).collect())
    want = sorted(sorted((str(i) for i in range(3000)), key=lambda k: (hashlib.md5(k.encode()).hexdigest(), k))[:150])
    assert got == want and deterministic_sample(df.limit(0), "k", 5).count() == 0 and deterministic_sample(df.limit(3), "k", 5).count() == 1


def test_sequence_has_no_gaps(spark):
    df = spark.range(1000).selectExpr("(id * 7919) % 1000 AS x").repartition(7)
    got = {r.x: r.sequence for r in with_sequence(df, ["x"]).collect()}
    assert got == {x: x + 1 for x in range(1000)}
    assert with_sequence(df.limit(0), ["x"]).count() == 0


def test_differences(spark):
    a = spark.createDataFrame([("1", "x"), ("2", None), (None, "z")], "k string, v string")
    b = spark.createDataFrame([("1", "y"), ("2", None), ("3", "w")], "k string, v string")
    assert sorted(map(str, rows_any(differences(a, b, ["k"], ["v"])))) == sorted(map(str, [("1", "changed", "v"), (None, "only_left", None), ("3", "only_right", None)]))


def rows_any(df):
    return [tuple(r) for r in df.collect()]


def test_interpolation(spark):
    data = [("s", 10, 47.5, 19.1, "exact", "a"), ("s", 50, 47.6, 19.2, "exact", "b"), ("s", 25, None, None, "street", "c"), ("s", 60, None, None, "street", "d"), ("s", 5, None, None, "street", "e"), ("t", 1, 47.0, 19.0, "exact", "f"), ("t", 2, None, None, "street", "g"), ("s", None, None, None, "street", "h")]
    df = spark.createDataFrame(data, "g string, n int, lat double, lon double, q string, id string")
    got = {r.id: (round(r.new_latitude, 6), round(r.new_longitude, 6), r.new_source) for r in interpolate(df, ["g"], "n", "lat", "lon", "q", "id").collect()}
    assert got == {"c": (47.5375, 19.1375, "interpolated (10-50)"), "d": (47.601, 19.201, "extrapolated (nearest: 50)"), "e": (47.5, 19.1, "extrapolated (nearest: 10)")}


def test_better_wins_and_fuzzy(spark):
    old = spark.createDataFrame([("a", "street", 1.0), ("b", "exact", 1.0), ("c", "failed", None)], "k string, quality string, x double")
    new = spark.createDataFrame([("a", "exact", 2.0), ("b", "exact", 2.0), ("c", "interpolated", 2.0)], "k string, quality string, x double")
    assert rows(better_wins(old, new, "k", ["x"]).fillna(-1)) == [("a", "exact", 2.0), ("b", "exact", 1.0), ("c", "failed", -1.0)]
    left = spark.createDataFrame([("z", "kossuth", 1), ("z", "qqqq", 2)], "b string, t string, i int")
    right = spark.createDataFrame([("z", "kosuth", 9), ("z", "kosuth", 8), ("y", "kossuth", 7)], "b string, u string, j int")
    assert [(r.left_id, r.right_id) for r in best_fuzzy(left, right, "b", "t", "u", "i", "j").collect()] == [(1, 8)]


def test_fuzzy_against_brute_force(spark):
    r = random.Random(11)
    word = lambda: "".join(r.choice("aáeköstrl n") for _ in range(r.randrange(1, 12)))
    slip = lambda w: w[: len(w) // 2] + r.choice("xyz") + w[len(w) // 2 + r.randrange(2) :]
    left = [("b1" if i % 3 else "b2", word()) for i in range(120)]
    right = [("b1" if i % 3 else "b2", slip(w) if i % 2 else word(), i) for i, (_, w) in enumerate(left)]

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y)))
        return row[-1]

    def similarity(a, b):
        return 1 - distance(a.encode(), b.encode()) / max(len(a), len(b))

    want = {}
    for block, w in left:
        best = min(((-similarity(w, u), i) for c, u, i in right if c == block and similarity(w, u) >= 0.6), default=None)
        if best:
            want[block, w] = best[1]
    a = spark.createDataFrame([(b, w, f"{b}/{w}") for b, w in set(left)], "b string, t string, i string")
    got = best_fuzzy(a, spark.createDataFrame(right, "b string, u string, j int"), "b", "t", "u", "i", "j")
    assert {tuple(x.left_id.split("/", 1)): x.right_id for x in got.collect()} == want and len(want) > 50


def test_nearest_against_brute_force(spark):
    r = random.Random(7)
    spread = lambda n, name: [(f"{name}{i}", max(-90.0, min(90.0, r.choice((47.5, -10.0, 89.9, 0.0)) + r.gauss(0, r.choice((0.001, 1, 30))))), (r.choice((19.0, 179.99, -60.0)) + r.gauss(0, r.choice((0.001, 1, 60))) + 180) % 360 - 180) for i in range(n)]
    a, b = spread(150, "a"), spread(80, "b")
    b += [("c", b[0][1], b[0][2]), ("bad", 91.0, 0.0), ("none", None, 1.0)]

    def metres(p, q):
        h = math.sin(math.radians(q[1] - p[1]) / 2) ** 2 + math.cos(math.radians(p[1])) * math.cos(math.radians(q[1])) * math.sin(math.radians(q[2] - p[2]) / 2) ** 2
        return 2 * 6371000 * math.asin(min(1, math.sqrt(h)))

    want = {p[0]: min((metres(p, q), q[0]) for q in b if q[1] is not None and abs(q[1]) <= 90) for p in a}
    df = lambda x: spark.createDataFrame(x, "k string, latitude double, longitude double")
    got = {x.left_key: (x.metres, x.right_key) for x in nearest(df(a), "k", df(b), "k").collect()}
    assert got.keys() == want.keys() and all(abs(got[k][0] - want[k][0]) < 1e-3 and (got[k][1] == want[k][1] or abs(got[k][0] - want[k][0]) < 1e-6) for k in want)
    assert nearest(df(a), "k", df(b).limit(0), "k").count() == 0


def test_points_within_against_brute_force(spark):
    r = random.Random(9)
    base = [(47.0, 19.0), (0.0, 179.999), (89.95, 10.0), (-89.99, -100.0), (60.0, -180.0)]
    spread = lambda n, name, s: [(f"{name}{i}", max(-90.0, min(90.0, base[i % 5][0] + r.uniform(-s, s))), (base[i % 5][1] + r.uniform(-s, s) / max(math.cos(math.radians(base[i % 5][0])), 1e-3) + 180) % 360 - 180) for i in range(n)]

    def metres(p, q):
        h = math.sin(math.radians(q[1] - p[1]) / 2) ** 2 + math.cos(math.radians(p[1])) * math.cos(math.radians(q[1])) * math.sin(math.radians(q[2] - p[2]) / 2) ** 2
        return 2 * 6371000 * math.asin(min(1, math.sqrt(h)))

    df = lambda x: spark.createDataFrame(x, "k string, latitude double, longitude double")
    for size, limit in ((0.1, 5000.0), (3.0, 200_000.0)):
        a, b = spread(150, "a", size), spread(150, "b", size)
        b += [("same", b[0][1], b[0][2]), ("bad", 91.0, 0.0), ("none", None, 1.0)]
        want = sorted((p[0], q[0]) for p in a for q in b if q[1] is not None and abs(q[1]) <= 90 and metres(p, q) <= limit)
        assert len(want) > 100 and rows(points_within(df(a), "k", df(b), "k", limit)) == want
    assert points_within(df(a), "k", df(b).limit(0), "k", 5.0).count() == 0


def test_regions_overlap(spark):
    square = lambda y, x, n: f"{y} {x},{y} {x + n},{y + n} {x + n},{y + n} {x}"
    df = spark.createDataFrame([("a", square(1, 1, 4)), ("b", square(5, 1, 4)), ("c", square(3, 3, 4)), ("d", square(1.5, 1.5, 0.5)), ("e", None), ("a", square(1, 1, 4))], "id string, poly string")
    assert rows(regions_overlap(df, "id", "poly")) == [("a", "c"), ("a", "d"), ("b", "c")]
    assert rows(regions_overlap(df.limit(0), "id", "poly")) == []


def test_retry_and_keywords(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    wants = lambda q, m: one(wants_retry(F.lit(q), F.lit(m)))
    assert [wants(q, m) for q in ("failed", "settlement", "street", "exact") for m in (None, "settlement", "street", "exact")] == [True] * 4 + [False, True, True, True] + [False, False, True, True] + [False] * 4
    assert [one(quality_by_keyword(F.lit(k))) for k in ("House number", "residential road", "Town", "x", None)] == ["exact", "street", "settlement", "failed", "failed"]
    assert tuple(one(answer_place(F.lit('{"items":[{"position":{"lat":1.5,"lng":2.5},"resultType":"street"},{"resultType":"x"}]}')))) == (1.5, 2.5, "street", "street")
    assert tuple(one(answer_place(F.lit('{"items":[]}')))) == tuple(one(answer_place(F.lit("broken")))) == (None, None, None, None)


def test_closed_subset(spark):
    df = lambda rows_, schema: spark.createDataFrame(rows_, schema)
    tables = {
        "county": df([("c1", "01", "Főváros"), ("c2", "02", "A"), ("c3", "03", "B"), ("c4", "04", "C")], "id string, county_code string, county_name string"),
        "settlement": df([(f"s{c}{i}", f"c{c}", f"{i:03d}") for c in range(1, 5) for i in range(1, 5)], "id string, county_id string, settlement_code string"),
        "polling_station": df([("p1", "s11"), ("p2", "s14"), ("p3", None)], "id string, settlement_id string"),
        "address": df([("a1", "s11", "z1"), ("a2", "s14", "z2"), ("a3", "s21", None)], "id string, settlement_id string, postal_code_id string"),
        "address_mapping": df([("a1", "k1"), ("a2", "k1"), ("a2", "k2"), ("a3", "k3")], "original_address_id string, canonical_address_id string"),
        "canonical_address": df([("k1",), ("k2",), ("k3",)], "id string"), "postal_code": df([("z1",), ("z2",)], "id string"),
        "address_polling_stations": df([("k1", "p1"), ("k2", "p2")], "canonical_address_id string, polling_station_id string"),
    }
    chosen = chosen_settlements(tables["settlement"], tables["county"], "Főváros", 2, 1, 2)
    assert rows(chosen) == [("s11",), ("s12",), ("s21",), ("s31",)]
    got = {k: rows(v) for k, v in closed_subset(tables, chosen).items()}
    assert [x[0] for x in got["county"]] == ["c1", "c2", "c3"] and [x[0] for x in got["address"]] == ["a1", "a3"] and got["postal_code"] == [("z1",)]
    assert got["address_mapping"] == [("a1", "k1"), ("a3", "k3")] and got["canonical_address"] == [("k1",), ("k3",)] and got["address_polling_stations"] == [("k1", "p1")] and got["polling_station"] == [("p1", "s11")]


def test_station_places(spark):
    where = [("s1", "Kisfalu", "k1", D(1)), ("s2", "Nagyfalu", " K1 ", D(1)), ("s3", "Üresfalu", None, D(1))]
    se = spark.createDataFrame(where, "id string, settlement_name string, county_id string, loaded_at timestamp")
    co = spark.createDataFrame([("k1", "01", D(1)), ("k2", "02", D(1))], "id string, county_code string, loaded_at timestamp")
    address = [("c1", "01", "KISFALU", "Petőfi utca 3.", "exact", 1.0), ("c2", "01", "Kisfalu", "Kossuth Lajos utca 12.", "street", 2.0), ("c3", "01", "Nagyfalu", "Alma tér 4.", "exact", 3.0), ("c4", "02", "Kisfalu", "Alma tér 4.", "exact", 9.0), ("c5", "01", "Kisfalu", "Fő út 1.", "settlement", 9.0), ("c6", "01", "Kisfalu", "Fő út 1.", "exact", None), ("c7", "01", "Kisfalu", "Almajárás 8.", "exact", 1.5)]
    ca = spark.createDataFrame([(*x, x[5]) for x in address], "id string, county_code string, settlement_name string, full_address string, geocoding_quality string, latitude double, longitude double")
    stations = [
        ("own", "Petőfi utca 3.", "s1", None, 5.0, D(1)), ("whole", "PETOFI UTCA 3 (Iskola)", "S1 ", None, None, D(1)), ("parts", "Művelődési Ház, Kossuth Lajos utca 12.", "s1", None, None, D(1)),
        ("slip", "Kosuth L. utca 12", "s1", None, None, D(2)), ("slip", "old", "s1", None, 8.0, D(1)), ("elsewhere", "Alma tér 4.", "s1", "k1", None, D(1)), ("other", "Alma tér 4.", "s2", "gone", None, D(1)), ("centre", None, "s1", None, None, D(1)), ("failed", "Fő út 1.", "s3", "k1", None, D(1)), ("lost", "Fő út 1.", None, None, None, D(1)), ("bare", "Polgármesteri Hivatal", "s1", None, None, D(1)),
    ]
    st = spark.createDataFrame([(*x[:5], x[4], x[5]) for x in stations], "id string, polling_station_address string, settlement_id string, county_id string, latitude double, longitude double, loaded_at timestamp")
    got = {r.id: (r.quality, r.source, r.matched_id, r.latitude) for r in station_places(st, se, co, ca).collect()}
    centre = ("settlement", "settlement_centroid", None, 1.5)
    assert got == {
        "own": ("exact", "station", None, 5.0), "whole": ("exact", "canonical_whole", "c1", 1.0), "parts": ("street", "canonical_parts", "c2", 2.0), "slip": ("street", "canonical_similar", "c2", 2.0),
        "elsewhere": centre, "other": ("exact", "canonical_whole", "c3", 3.0), "centre": centre, "bare": centre, "failed": ("failed", None, None, None), "lost": ("failed", None, None, None),
    }
    assert station_places(st.limit(0), se, co, ca).count() == 0 and {r.quality for r in station_places(st, se, co, ca.limit(0)).collect()} == {"exact", "failed"}
