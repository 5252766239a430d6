"""Text operations on addresses as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.keys import text_of

def all_digits(c: Column) -> Column:
    """Whether a text is made of the digits 0 to 9, at least one."""
    return (c != "") & (F.translate(c, "0123456789", "") == "")


def _strip_zeros(c: Column, empty: str = "0") -> Column:
    """Without leading zeros; ``empty`` where nothing is left."""
    t = F.ltrim(c, F.lit("0"))
    return F.when(t == "", F.lit(empty)).otherwise(t)


def trim_zeros(c: Column | str, null_value: str | None = "") -> Column:
    """Leading zeros off a house number: of both sides of the first dash, of the number before a slash, of plain digits.

    Null and empty give ``null_value`` (``None`` keeps them). All zeros leave one.
    """
    c = F.col(c) if isinstance(c, str) else c
    dash = F.instr(c, "-")
    left, right = F.substring_index(c, "-", 1), F.substring(c, dash + 1, F.length(c))
    ranged = F.concat(_strip_zeros(left), F.lit("-"), _strip_zeros(right))
    slashed = F.when(c.rlike("^[0-9]+/"), F.concat(_strip_zeros_keep(F.substring_index(c, "/", 1)), F.substring(c, F.instr(c, "/"), F.length(c)))).otherwise(c)
    out = F.when(dash > 0, ranged).when(c.contains("/"), slashed).when(all_digits(c), _strip_zeros(c)).otherwise(c)
    return F.when(c.isNull() | (c == ""), F.lit(null_value) if null_value is not None else c).otherwise(out)


def _strip_zeros_keep(c: Column) -> Column:
    """Leading zeros off, the last digit always kept."""
    return F.regexp_replace(c, "^0+(?=[0-9])", "")


def trim_zeros_export(c: Column | str) -> Column:
    """Export variant: text ``NULL`` and blanks give empty; every part of a range; also digits followed by letters."""
    t = F.trim(text_of(c))
    parts = F.array_join(F.transform(F.split(t, "-"), lambda p: F.when(p.rlike("^0*[0-9]+.*"), _strip_zeros_keep(p)).otherwise(p)), "-")
    return F.when((t == "") | (t == "NULL"), "").otherwise(parts)


def clean_house_number(c: Column | str) -> Column:
    """House number for matching: no leading zeros; empty if it is, or a side of it is, all zeros."""
    t = F.trim(text_of(c))
    base = F.substring_index(t, "/", 1)
    zero_side = F.exists(F.split(base, "-"), lambda p: (F.ltrim(p, F.lit("0")) == "") & (F.length(p) > 0))
    ranged = F.concat(F.array_join(F.transform(F.split(base, "-"), lambda p: F.ltrim(p, F.lit("0"))), "-"), F.substring(t, F.length(base) + 1, F.length(t)))
    return F.when(all_digits(t) | (t == ""), F.ltrim(t, F.lit("0"))).when(zero_side, "").otherwise(ranged)


def clean_unit(c: Column | str) -> Column:
    """Building or staircase: digits without leading zeros (all zeros are none), otherwise upper case."""
    t = F.trim(text_of(c))
    return F.when(all_digits(t), F.ltrim(t, F.lit("0"))).otherwise(F.upper(t))


def zero_only_to_empty(c: Column | str) -> Column:
    """Empty text for text of zeros only."""
    t = text_of(c)
    return F.when(t.rlike("^0+$"), "").otherwise(t)


def clean_zero_field(c: Column | str) -> Column:
    """Empty text for nothing, the text ``NULL`` and text of zeros only, blanks around them aside."""
    t = text_of(c)
    return F.when((t == "") | (t == "NULL") | F.trim(t).rlike("^0+$"), "").otherwise(t)


def strip_leading_zeros_regex(c: Column | str) -> Column:
    """Leading zeros off where another digit from 1 to 9 follows, otherwise unchanged."""
    t = text_of(c)
    return F.when(t.rlike("^0+[1-9]"), F.ltrim(t, F.lit("0"))).otherwise(t)


def roman(c: Column | str) -> Column:
    """Roman numeral of 1 to 3999; other text unchanged. Built by place value, one digit at a time."""
    t = text_of(c)
    n = t.try_cast("int")

    def digit(value: Column, one: str, five: str, ten: str) -> Column:
        forms = ["", one, one * 2, one * 3, one + five, five, five + one, five + one * 2, five + one * 3, one + ten]
        return F.element_at(F.array(*map(F.lit, forms)), (value % 10 + 1).cast("int"))

    out = F.concat(F.repeat(F.lit("M"), (n / 1000).cast("int")), digit((n / 100).cast("int"), "C", "D", "M"), digit((n / 10).cast("int"), "X", "L", "C"), digit(n, "I", "V", "X"))
    return F.when(all_digits(t) & n.between(1, 3999), out).otherwise(t)


def _address_parts(name: Column, kind: Column, house: Column, building: Column, stairs: Column) -> dict[str, Column]:
    """What the decision table of ``full_address`` looks at."""
    raw, b_raw, s_raw = (F.trim(text_of(c)) for c in (house, building, stairs))
    return {
        "p": F.trim(F.concat(text_of(name), F.lit(" "), text_of(kind))),
        "h": clean_house_number(house),
        "b": F.when(all_digits(b_raw), _strip_zeros(b_raw)).otherwise(F.upper(b_raw)),
        "s": F.when(all_digits(s_raw), roman(_strip_zeros(s_raw))).otherwise(F.upper(s_raw)),
        "slash": raw.contains("/"),
        "spelled": raw.contains("-") | (all_digits(b_raw) & all_digits(s_raw)),
    }


def _address_text(p: Column, h: Column, b: Column, s: Column, slash: Column, spelled: Column) -> Column:
    has_b, has_s = b != "", s != ""
    building, stairs = F.concat(b, F.lit(". épület")), F.concat(s, F.lit(". lépcsőház"))
    line = lambda *parts: F.concat(p, *parts)
    bare = F.when(has_b & has_s, line(F.lit(", "), building, F.lit(" "), stairs)).when(has_b, line(F.lit(", "), building)).when(has_s, line(F.lit(", "), stairs)).otherwise(p)
    out_of = lambda number: line(F.lit(" "), number, F.lit(". "), building, F.lit(" "), stairs)
    slashed = F.when(has_b & has_s, out_of(F.substring_index(h, "/", 1))).when(has_s, line(F.lit(" "), h, F.lit(". "), stairs)).otherwise(line(F.lit(" "), h, F.lit(".")))
    both = F.when(spelled, out_of(h)).otherwise(line(F.lit(" "), h, F.lit("/"), b, F.lit(". "), stairs))
    single = line(F.lit(" "), h, F.lit("/"), F.when(has_b, b).otherwise(s), F.lit("."))
    plain = F.when(has_b & has_s, both).when(has_b | has_s, single).otherwise(line(F.lit(" "), h, F.lit(".")))
    return F.when(h == "", bare).when(slash, slashed).otherwise(plain)


def full_address(name: Column, kind: Column, house: Column, building: Column, stairs: Column) -> Column:
    """Formatted address by the decision table over house, building and staircase.

    A slash letter gives way to a building if a staircase is named too; a single unit joins the number with a
    slash; two numeric units, or a range, are written out; a slash with a building alone drops the building.
    """
    return _address_text(**_address_parts(name, kind, house, building, stairs))


def with_full_address(df: DataFrame, name: str, kind: str, house: str, building: str, stairs: str, out: str = "full_address") -> DataFrame:
    """``df`` with ``full_address`` as a column; what the table looks at is computed once for each row."""
    parts = _address_parts(*map(F.col, (name, kind, house, building, stairs)))
    made = df.withColumns({f"__{k}": v for k, v in parts.items()})
    return made.withColumn(out, _address_text(**{k: F.col(f"__{k}") for k in parts})).drop(*(f"__{k}" for k in parts))


def plain_address(*parts: Column) -> Column:
    """Parts joined by blanks as they are, ends trimmed; null parts are left out."""
    return F.trim(F.concat_ws(" ", *parts))


def collapsed_address(name: Column, kind: Column, house: Column, *units: Column) -> Column:
    """Trimmed parts joined by single blanks; null if the name or the house number is."""
    return F.when(name.isNotNull() & house.isNotNull(), F.trim(F.regexp_replace(F.concat_ws(" ", name, kind, house, *units), r"\s+", " ")))


def joined_address(*parts: Column) -> Column:
    """The parts that are neither null nor empty, joined by blanks."""
    return F.concat_ws(" ", *(F.nullif(p, F.lit("")) for p in parts))


def structure_score(house: Column | str, building: Column | str, stairs: Column | str) -> Column:
    """How well an address is split into fields: 100 without slash (+10 building, +10 staircase), else 50 (+5, +10)."""
    h, b, s = text_of(house), text_of(building), text_of(stairs)
    slash = h.contains("/")
    return F.when(slash, 50).otherwise(100) + F.when(b != "", F.when(slash, 5).otherwise(10)).otherwise(0) + F.when(s != "", 10).otherwise(0)


def export_score(house: Column | str, building: Column | str, stairs: Column | str) -> Column:
    """Export priority: 100 with a building, 90 with a staircase, both without slash in the number; else 50."""
    h, b, s = text_of(house), text_of(building), text_of(stairs)
    return F.when(~h.contains("/") & ~b.isin("", "0"), 100).when(~h.contains("/") & ~s.isin("", "0"), 90).otherwise(50)


def normal_text(c: Column | str) -> Column:
    """Trimmed, single blanks, upper case."""
    return F.upper(F.regexp_replace(F.trim(text_of(c)), r"\s+", " "))


def snake_case(c: Column | str) -> Column:
    """``CountyCode`` to ``county_code``."""
    t = F.regexp_replace(text_of(c), "([a-z0-9])([A-Z])", "$1_$2")
    return F.lower(F.regexp_replace(t, "([A-Z]+)([A-Z][a-z])", "$1_$2"))


def snake_case_text(name: str) -> str:
    """``snake_case`` for a name at hand."""
    return re.sub("([A-Z]+)([A-Z][a-z])", r"\1_\2", re.sub("([a-z0-9])([A-Z])", r"\1_\2", name)).lower()


def house_int(c: Column | str) -> Column:
    """Leading number of a house number, or null."""
    return F.regexp_extract(F.trim(text_of(c)), "^([0-9]+)", 1).try_cast("int")


def folded(c: Column | str) -> Column:
    """Letters and digits only, in lower case and without Hungarian accents."""
    return F.regexp_replace(F.translate(F.lower(text_of(c)), "áéíóöőúüű", "aeiooouuu"), "[^a-z0-9]", "")


def without_parentheses(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(text_of(c), r"\s*\([^)]*\)\s*", " "))


# Fixed value: how a street with a number is written in a station's address.
STATION_STREET = r"([a-záéíóöőúüű\s]+(?:utca|út|tér|köz|körút|sétány|park|sor))\s*(\d+[a-z\-/\.]*)"


def station_street(c: Column | str) -> Column:
    """Street and number in lower case out of a station's text, or null."""
    t = F.lower(text_of(c))
    street, number = F.trim(F.regexp_extract(t, STATION_STREET, 1)), F.regexp_extract(t, STATION_STREET, 2)
    return F.when(street != "", F.concat(street, F.lit(" "), number))


# Institutions that stations are in; taken out of an address before its street is looked for.
INSTITUTIONS = (
    "általános iskola", "gimnázium", "szakközépiskola", "művelődési ház", "közösségi ház", "kultúrház",
    "polgármesteri hivatal", "önkormányzat", "óvoda", "iskola", "könyvtár", "sportcsarnok",
)


def station_components(c: Column | str) -> Column:
    """Street and number of a station's address without names of institutions; else the address without commas and double blanks, or null if that is the same."""
    bare = F.lower(F.regexp_replace(text_of(c), "(?iu)" + "|".join(INSTITUTIONS), ""))
    street = F.trim(F.regexp_extract(bare, STATION_STREET, 1))
    cleaned = F.trim(F.regexp_replace(F.regexp_replace(bare, "[,;]", " "), r"\s+", " "))
    return F.when(F.regexp_extract(bare, STATION_STREET, 0) != "", F.concat(street, F.lit(" "), F.trim(F.regexp_extract(bare, STATION_STREET, 2)))).when(cleaned != bare, cleaned)


def byte_similarity(a: Column, b: Column) -> Column:
    """1 - Levenshtein distance over the longer length, letters counted as UTF-8 bytes in the distance and as characters in the length."""
    raw = lambda c: F.decode(F.encode(F.lower(c), "UTF-8"), "ISO-8859-1")
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest > 0, 1 - F.levenshtein(raw(a), raw(b)) / longest)


def sql_literal(c: Column | str) -> Column:
    """Quoted SQL literal."""
    return F.concat(F.lit("'"), F.replace(text_of(c), F.lit("'"), F.lit("''")), F.lit("'"))


def duration_text(seconds: Column) -> Column:
    """Seconds as ``x.xs``, ``x.xm`` or ``x.xh``."""
    return F.when(seconds < 60, F.format_string("%.1fs", seconds)).when(seconds < 3600, F.format_string("%.1fm", seconds / 60)).otherwise(F.format_string("%.1fh", seconds / 3600))


def file_name(c: Column | str) -> Column:
    """Text with both kinds of slashes replaced."""
    return F.translate(text_of(c), "/\\", "__")
