"""Survivors of groups, and addresses written differently."""

import datetime as dt
import random

from tessera.llm.addresses import address_classes, address_pairs, house_parts, neighbours, one_error, penalty, read_address
from tessera.llm.survivors import DESCRIPTION, survivors

D = lambda d: dt.datetime(2025, 7, d)
RECORD = "id string, accessibility_flag string, building string, staircase string, pir_code string, latitude double, longitude double, record_source string, updated_at timestamp, g string, mask int"


def run(spark, records, pairs):
    r = spark.createDataFrame([(*x, "g", 1) for x in records], RECORD)
    m = spark.createDataFrame([(a, b, "z") for a, b in pairs], "original_address_id string, canonical_address_id string, id string")
    t = spark.createDataFrame([("high", 2), ("low", 1)], "record_source string, trust_rank int")
    return {x.canonical_address_id: x for x in survivors(r, m, t).collect()}


def test_survivors(spark):
    full = ("I", "A", "1", "1000", 47.0, 19.0)
    records = [
        ("a1", *full, "high", D(5)), ("a2", "N/A", None, " ", "-", None, 19.0, "low", D(4)),
        ("b1", *full, "low", D(5)), ("b2", "I", None, None, None, None, None, "high", D(5)),
        ("c1", *full, "high", D(5)), ("c2", *full, "high", D(5)),
        ("d1", *full, "high", D(5)),
        ("e1", None, None, None, None, None, None, None, None), ("e2", None, None, None, None, None, None, "other", None),
        ("f1", "I", None, None, None, float("nan"), 1.0, "high", D(2)), ("f2", None, None, None, None, None, None, "unlisted", D(1)),
        ("a1", *full, "high", D(5)), (None, *full, "high", D(9)),
    ]
    pairs = [(r[0], r[0][0].upper()) for r in records if r[0]] + [("gone", "D"), (None, "A"), ("a1", None), ("a2", "A")]
    got = run(spark, records, pairs)
    assert sorted(got) == ["A", "B", "C", "E", "F"]
    assert {k: v.whole_record_id for k, v in got.items()} == {"A": "a1", "B": None, "C": None, "E": None, "F": "f1"}
    assert got["B"].accessibility_flag == "I" and got["B"].building == "A" and got["B"].n_records == 2 and got["A"].latitude == 47.0
    assert got["E"].building is None and got["E"].latest is None and got["F"].latitude is None
    assert run(spark, [], []) == {} and run(spark, records, []) == {}


def test_survivors_of_all_columns(spark):
    schema = RECORD + ", county_code string, settlement_name string, street_name string, house_number string, full_address string, geocoding_quality string"
    five = (None, None, None, None)
    records = [
        # The most trusted has no street and no point; the two others are equal in trust and time.
        ("a1", *five, None, None, "high", D(5), "01", "Kisfalu", "n/a", None, " ", "failed"),
        ("a2", *five, 47.0, 19.0, "low", D(4), "01", "Kisfalva", "Zeta utca", "1", "Zeta utca 1.", "street"),
        ("a3", *five, 46.0, 19.0, "low", D(4), "02", "Kisfalva", "Alfa utca", "2", "Alfa utca 2.", "exact"),
        ("b1", *five, None, None, "high", D(5), None, None, None, None, None, None),
        ("b2", *five, None, None, "low", D(5), None, None, "Fő út", None, None, "failed"),
    ]
    r = spark.createDataFrame([(*x[:9], "g", 1, *x[9:]) for x in records], schema)
    m = spark.createDataFrame([(x[0], x[0][0].upper()) for x in records], "original_address_id string, canonical_address_id string")
    t = spark.createDataFrame([("high", 2), ("low", 1)], "record_source string, trust_rank int")
    got = {x.canonical_address_id: x for x in survivors(r, m, t, description=DESCRIPTION, quality="geocoding_quality").collect()}
    one = lambda x: (*(x[c] for c in DESCRIPTION), x.geocoding_quality, x.latitude)
    assert one(got["A"]) == ("01", "Kisfalu", "Alfa utca", "2", "Alfa utca 2.", "high", "exact", 46.0)
    assert one(got["B"]) == (None, None, "Fő út", None, None, "high", "failed", None)


def test_edit_distance():
    assert [one_error(a, b, 2) for a, b in [("abc", "abc"), ("abc", "acb"), ("abc", "ab"), ("abc", "abxc"), ("abc", "xyz"), ("", "ab"), ("abcd", "badc")]] == [0, 1, 1, 1, 3, 2, 2]


def test_house_parts():
    forms = {"000005": ("5", ""), "5.": ("5", ""), "0005/b": ("5", "B"), "14–18": ("14-18", ""), "18 - 20": ("18-20", ""), "1-00005": ("1-5", ""), "7.A": ("7", "A"), "7 D": ("7", "D"), "7A": ("7", "A"), "000": None, "": None, "hrsz 12": None}
    assert {k: house_parts(k) for k in forms} == forms


def test_reading():
    want = ("kerekgolyafok", "utca", "16", "D", "")
    for a in [("Kerek Gólyafok", "utca", "000016/D", "", "", "", "parts"), ("utca Kerek Gólyafok", "Utca", "16", "d", "", "", "parts"), ("16/D KEREK GÓLYAFOK U.", "", "", "", "", "", "parts"), ("", "", "", "", "", "Kerek Gólyafok utca 16. D. épület", "full"), ("", "", "", "", "", "Iskola, Kerek-Gólyafok utcza 16/D.", "station"), ("", "", "", "", "", "16/D. Kerek Gólyafok utca Kult. ház", "station")]:
        p = read_address(*a)
        assert (p[1], *p[5:]) == want, a
    assert read_address("", "", "", "", "", "", "parts")[1] == ""
    kinds = {"Bodza kzö": "koz", "Bodza tca": "utca", "utczaa Bodza": "utca", "Bodza téér": "ter", "Kere kRozszug": "", "Hármas kút": ""}
    assert {k: read_address(k, "", "", "", "", "", "parts")[5] for k in kinds} == kinds


def test_penalty():
    form = lambda name, kind="utca": read_address(name, kind, "", "", "", "", "parts")[:6]
    base = form("Kerek Gólyafok")
    assert penalty(base, base) == 0 and penalty(base, form("Kerek Gólyafok", "")) == 0.25
    assert penalty(base, form("K. Gólyafok")) == 0.5 and penalty(base, form("Kerek Golyafok")) == 0.5
    assert penalty(base, form("Keer. Gólyafok")) == 2.5 and penalty(base, form("Keer. Gólayfok")) == 9 and penalty(base, form("Na. Gólyafok")) == 9
    assert penalty(base, form("Kerek Gólayfok")) == 2 and penalty(base, form("Nagy Gólyafok")) == 9 and penalty(base, form("Kerek Gólyafok", "tér")) == 9


STAGING = "row_id long, run_tag string, county_code string, settlement_name string, street_name string, street_type string, house_number string, building string, staircase string, gate_code string, place string"


def test_address_pairs(spark):
    g = lambda code, street, kind, house, b=None, s=None, run="2", town="Kisfalu": (1, run, " 01", town, street, kind, house, b, s, code, "x")
    staging = [
        *(g(f"s{i}", "Kerek Gólyafok", "utca", f"{i:06d}") for i in range(1, 8)), *(g(f"t{i}", "Kis Gólyafok", "tér", f"{i:06d}") for i in range(1, 6)),
        g("v1", "KEREK GÓLYAFOK UTCA 1.", None, ""), g(" v2 ", "Kerek Gólayfok", "u.", "2"), g("v3", "K. Gólyafok", None, "3"), g("v4", "Kerek Gólyafok", "utca", "000004/A"), g("v5", "Kerek Gólyafok", "utca", "4", "A"),
        g("v6", "Kerek Gólyafok", "utca", "000001", run="1"), g("v7", "Kerek Gólyafok", "utca", "000001", town="Nagyfalu"), g(None, "Kerek Gólyafok", "utca", "1"), g("v8", None, None, None), g("s1", "Kerek Gólyafok", "utca", "000001"), g("v9", "", "utca", "1"), g("w1", "Kerek Gólyafokutca", None, "5"),
    ]
    canonical = [("c1", "01", "Kisfalu", "Kerek Gólyafok", "1", None, None, "Kerek Gólyafok utca 1."), ("c2", "01", "KISFALU", "Kerek-Golyafok", "000001", None, None, "Kerek-Golyafok 1."), ("c3", "01", "Kisfalu", "Kerek Gólyafok", "1", None, None, "Kerek Gólyafok utca 1."), (None, "01", "Kisfalu", "x", "1", None, None, "x"), ("c4", None, None, None, None, None, None, None)]
    stations = [("p1", "S ", "Öreg Jegenye utca 12. (Gimn.)"), ("p2", "s", "Iskola, Öreg Jegnye u. 12"), ("p3", "s", "ÖREG JEGENYE UTCA (ÓVODA)"), ("p4", "s", "Új Fasor tér 1. (Óvoda)"), ("p5", None, None), ("p6", "s", "Új Fasor tér 2. (Óvoda)"), ("p7", "s", "Új Fasor tér (Óvoda)"), ("p8", "s", "Új Fasor tér (Iskola)")]
    df = lambda rows, schema: spark.createDataFrame(rows, schema)
    args = (
        df(staging, STAGING), df(canonical, "id string, county_code string, settlement_name string, street_name string, house_number string, building string, staircase string, full_address string"),
        df([("c3", "x")], "original_address_id string, canonical_address_id string"), df(stations, "id string, settlement_id string, polling_station_address string"))
    got = {tuple(r) for r in address_pairs(*args).collect()}
    assert got == {("gate", "s1", "v1"), ("gate", "s2", "v2"), ("gate", "s3", "v3"), ("gate", "v4", "v5"), ("gate", "s5", "w1"), ("canonical", "c1", "c2"), ("station", "p1", "p2"), ("station", "p1", "p3"), ("station", "p2", "p3")}
    assert address_pairs(*(x.limit(0) for x in args)).count() == 0


def test_slips_in_short_names_meet(spark):
    # No letters have to agree for two forms to be compared: the first three and the last three differ here.
    g = lambda code, street, house: (1, "2", "01", "Kisfalu", street, "utca", house, None, None, code, "x")
    rows = [g(f"a{i}", "Rózsa", str(i)) for i in range(1, 9)] + [g("b1", "Rósza", "1")]
    rows += [g(f"d{i}", "Dózsa", str(i)) for i in range(1, 9)] + [g("e1", "Dóssa", "3")]
    rows += [g(f"x{i:02d}", f"{c}{d}{c.lower()}{d}lak", "7") for i, (c, d) in enumerate((c, d) for c in "BCFGH" for d in "aeiou")]
    empty = "id string, county_code string, settlement_name string, street_name string, house_number string, building string, staircase string, full_address string"
    others = spark.createDataFrame([], empty), spark.createDataFrame([], "original_address_id string"), spark.createDataFrame([], "id string, settlement_id string, polling_station_address string")
    staging = spark.createDataFrame(rows, STAGING)
    assert {tuple(r) for r in address_pairs(staging, *others).collect()} == {("gate", "a1", "b1"), ("gate", "d3", "e1")}
    assert {tuple(r)[:2] for r in address_classes(staging, *others).collect()} == {("gate", r[9]) for r in rows}


def test_windows_reach_over_blocks(spark):
    r = random.Random(4)
    names = sorted({"".join(r.choice("abcdefghij") for _ in range(7)) for _ in range(60)})
    names += [n[:3] + "z" + n[4:] for n in names[:20]]
    form = lambda i, n: (i, "x", n, n, "", "", "", "utca", 5 if i < 60 else 1)
    forms = spark.createDataFrame([form(i, n) for i, n in enumerate(names)], "form_id long, area string, accented string, folded string, head string, abbreviation string, rest string, kind string, support int")
    numbered = forms.selectExpr("form_id", "'1' AS number")
    whole, cut_up = ({tuple(x) for x in neighbours(forms, numbered, block=size).collect()} for size in (4096, 7))
    assert whole == cut_up and {(a, b) for a, b, _ in whole} >= {(i, 60 + i) for i in range(20)}
