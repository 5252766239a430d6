"""Literal cases of the text, key and geometry functions: every branch of their rules, on made-up values."""

import hashlib
import uuid

import pytest
from pyspark.sql import functions as F

from tessera.functions import geo, keys
from tessera.functions import textops as X


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def each(spark, f, cases):
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(cases)], "i int, x string")
    got = {r.i: r.y for r in df.select("i", f("x").alias("y")).collect()}
    assert [got[i] for i in range(len(cases))] == [b for _, b in cases]


def test_house_number_for_matching(spark):
    each(spark, X.clean_house_number, [("0042", "42"), (" 7 ", "7"), ("00", ""), (None, ""), ("012/C", "12/C"), ("00/C", ""), ("003-0009", "3-9"), ("000-0009", ""), ("004-000", ""), ("003-0009/E", "3-9/E"), ("x12", "x12")])


def test_zeros_of_house_numbers(spark):
    each(spark, X.trim_zeros, [("0042", "42"), ("000", "0"), ("003-009", "3-9"), ("00-0", "0-0"), ("012/C", "12/C"), ("C/012", "C/012"), ("", ""), (None, ""), ("ab", "ab")])
    assert one(spark, X.trim_zeros(F.lit(None).cast("string"), None))[0] is None
    each(spark, X.trim_zeros_export, [("0042B", "42B"), ("NULL", ""), ("  ", ""), (" 08 ", "8"), ("003-0x-07", "3-0x-7"), ("00", "0"), ("ab-03", "ab-3")])
    each(spark, X.strip_leading_zeros_regex, [("0305", "305"), ("000", "000"), ("5", "5"), (None, "")])
    each(spark, X.zero_only_to_empty, [("000", ""), ("0a", "0a"), (None, "")])
    each(spark, X.clean_zero_field, [(" 00 ", ""), ("NULL", ""), (None, ""), ("0/1", "0/1"), (" a ", " a ")])
    each(spark, X.clean_unit, [("003", "3"), ("00", ""), (" b ", "B"), (None, "")])


def test_roman(spark):
    known = {4: "IV", 9: "IX", 14: "XIV", 40: "XL", 90: "XC", 444: "CDXLIV", 999: "CMXCIX", 1987: "MCMLXXXVII", 3888: "MMMDCCCLXXXVIII"}
    each(spark, X.roman, [(str(n), r) for n, r in known.items()] + [("0", "0"), ("4001", "4001"), ("k", "k"), (None, "")])


# Name, type, house, building, staircase and the address: one case for each branch of the decision table.
ADDRESSES = [
    ("Bodza", "köz", "0042/C", "", "", "Bodza köz 42/C."),
    ("Bodza", "köz", "0042/C", "3", "", "Bodza köz 42/C."),
    ("Bodza", "köz", "0042/C", "", "m", "Bodza köz 42/C. M. lépcsőház"),
    ("Bodza", "köz", "0042/C", "f", "m", "Bodza köz 42. F. épület M. lépcsőház"),
    ("Bodza", "köz", "42", "", "", "Bodza köz 42."),
    ("Bodza", "köz", "42", "f", "", "Bodza köz 42/F."),
    ("Bodza", "köz", "42", "", "m", "Bodza köz 42/M."),
    ("Bodza", "köz", "42", "f", "m", "Bodza köz 42/F. M. lépcsőház"),
    ("Bodza", "köz", "42", "02", "04", "Bodza köz 42. 2. épület IV. lépcsőház"),
    ("Bodza", "köz", "40-0044", "f", "m", "Bodza köz 40-44. F. épület M. lépcsőház"),
    ("Bodza", "köz", "00", "02", "03", "Bodza köz, 2. épület III. lépcsőház"),
    ("Bodza", "köz", "", "f", "", "Bodza köz, F. épület"),
    ("Bodza", "köz", None, None, "m", "Bodza köz, M. lépcsőház"),
    ("Bodza", "köz", "00-5", None, None, "Bodza köz"),
    ("", "köz", "9", None, None, "köz 9."),
]


@pytest.mark.parametrize("name,kind,house,building,stairs,want", ADDRESSES)
def test_full_address(spark, name, kind, house, building, stairs, want):
    assert one(spark, X.full_address(*(F.lit(x).cast("string") for x in (name, kind, house, building, stairs))))[0] == want


def test_other_addresses(spark):
    t = lambda *x: [F.lit(v).cast("string") for v in x]
    assert one(spark, X.collapsed_address(*t("Bodza ", " köz", "4", None, " F")))[0] == "Bodza köz 4 F"
    assert one(spark, X.collapsed_address(*t("Bodza", "köz", None, "F", None)), X.collapsed_address(*t(None, "köz", "4", None, None))) == (None, None)
    assert one(spark, X.joined_address(*t("Bodza", "", "4", None)), X.plain_address(*t(" Bodza", None, "4 "))) == ("Bodza 4", "Bodza 4")


def test_scores(spark):
    s = lambda f, *a: one(spark, f(*map(F.lit, a)))[0]
    assert [s(X.structure_score, *a) for a in (("4", "", ""), ("4", "F", ""), ("4", "", "M"), ("4", "F", "M"), ("4/F", "", ""), ("4/F", "F", ""), ("4/F", "F", "M"))] == [100, 110, 110, 120, 50, 55, 65]
    assert [s(X.export_score, *a) for a in (("4", "F", "M"), ("4", "0", "M"), ("4", "0", "0"), ("4/F", "F", "M"))] == [100, 90, 50, 50]


def test_station_texts(spark):
    each(spark, X.station_street, [("Bodza KÖZ 12/b", "bodza köz 12/b"), ("Kis Malom utca 3.", "kis malom utca 3."), ("Malom 3", None), (None, None)])
    each(spark, X.station_components, [("Kis Malom Iskola, Bodza köz 4", "bodza köz 4"), ("Óvoda; Malom  3", "malom 3"), ("malom 3", None), (None, None)])


def test_keys(spark):
    v, h = "0f1e2d3c4b5a6978", lambda t: hashlib.md5(t.encode()).hexdigest()
    got = one(spark, keys.uuid3(F.lit(v)), keys.uuid5(F.lit(v)), keys.uuid5(F.lit("")), keys.md5_16(F.lit("x"), F.lit(None)), keys.cache_key(F.lit("x"), F.lit("y")), keys.strict_md5_16(F.lit("x"), F.lit("y")), keys.strict_cache_key(F.lit("x"), F.lit(None)))
    assert got == (str(uuid.uuid3(keys.NAMESPACE, v)), str(uuid.uuid5(keys.NAMESPACE, v)), None, h("x|")[:16], h("x|y"), h("x|y")[:16], None)


def test_point_and_polygon(spark):
    each(spark, geo.point_wkt, [("12.5 33.25", "POINT(33.25 12.5)"), (" -7  8.0 ", "POINT(8.0 -7)"), ("90 180", "POINT(180 90)"), ("90.1 1", None), ("1 -180.5", None), ("1", None), ("1 2 3", None), ("a b", None), ("", None), (None, None)])
    ring = "POLYGON((2 1, 5 1, 5 4, 2 1))"
    each(spark, geo.polygon_wkt, [("1 2,1 5,4 5", ring), ("1 2,1 5,4 5,1 2", ring), ("1 2,?,1 5, 4  5", ring), ("1 2,1 5", None), (None, None)])
    each(spark, geo.swapped, [("1.5 2,3 4", "2 1.5,4 3"), (None, "")])
    assert one(spark, geo.shoelace(F.lit("0 0,0 3,5 3,5 0")))[0] == 15.0


def test_regions_that_touch(spark):
    df = spark.createDataFrame([("a", "0 0,0 2,2 2,2 0"), ("b", "0 2,0 4,2 4,2 2"), ("c", "2 2,2 5,5 5"), ("d", None), ("a", "0 0,0 2,2 2,2 0")], "id string, poly string")
    assert [tuple(r) for r in geo.touching(df, "id", "poly").collect()] == [("a", "b", 2)]
    assert sorted((r.a, r.b) for r in geo.touching(df, "id", "poly", 1).collect()) == [("a", "b"), ("a", "c"), ("b", "c")]
