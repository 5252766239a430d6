"""Same postal address written differently: multi-pass sorted neighbourhoods.

1. Records are read into parts: street name, street type, house number, letter or building, staircase.
   Distinct ways of writing are read once, whatever the number of records.
2. The distinct street forms of a settlement are sorted in differing component orders: name forward, name
   backward, last word first, and house number before name. In each order, forms in one window are compared:
   by an edit distance that counts a swap of neighbours as one error, with abbreviated first words matched by
   their beginning. The order is global and cut into blocks of equal size whose windows overlap, so a large
   settlement is spread over many tasks and no key has to agree for two forms to meet.
3. A rare form follows the commoner form it is a variant of, if only one can be meant; several equally
   good ones are kept as options until the house number tells.
4. Records of one street are the same place only if number, letter or building, and staircase agree
   strictly. A number that is left out is none only if the street has but one.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import blank_to_empty, cut

PLAIN = str.maketrans("áéíóöőúüűä", "aeiooouuua")
CACHED = 1 << 16  # texts whose reading each worker keeps
WINDOW = 10  # forms that a form is compared with on either side, in each order
ANCHORS = 6  # common forms that a rare form is compared with on either side, in each order
ANCHOR_SUPPORT = 3
BLOCK = 4096  # forms of the sorted order that one task compares at a time

# Street types and their ways of writing, without accents and case.
TYPES = {
    "utca": ["utca", "u", "utcza", "uca", "uta", "utc", "tca", "utcaja", "str"],
    "ut": ["ut", "utja"],
    "ter": ["ter", "tere", "t"],
    "koz": ["koz", "kz"],
    "sor": ["sor"],
    "setany": ["setany", "stny", "sny", "set"],
    "dulo": ["dulo", "d", "dul"],
    "lejto": ["lejto", "lej", "lejt"],
    "korut": ["korut", "krt"],
    "park": ["park"],
    "fasor": ["fasor", "fsr"],
    "lakotelep": ["lakotelep", "ltp", "lkt"],
    "sugarut": ["sugarut", "sgt"],
    "rakpart": ["rakpart", "rkp"],
    "liget": ["liget"],
    "telep": ["telep"],
}
TYPE_OF = {w: t for t, words in TYPES.items() for w in words}
# Words of institutions that stations are in, without accents; the beginning of the word decides.
INSTITUTION = re.compile(
    r"^(gimn|iskola|isk$|altalanos|alt$|ovoda|ov$|konyvtar|kvtar|kozseghaza|kozs|kozshaza|faluhaz|muvelodesi|muv$|muvhaz|mh$|kulturhaz|kult$|kulthaz|haz$|haza$|sportcs|tuzolto|tuzo$|szertar|polgarmesteri|polg|polgm|hivatal|hiv$|idosek|klubja|kl$|csarnok)"
)
NUMBER = re.compile(r"^(\d{1,6})(?:[-–—](\d{1,6}))?(?:/([a-z0-9]{1,4}))?([a-z]{0,2})\.?$")
ROMAN = {"i": "1", "ii": "2", "iii": "3", "iv": "4", "v": "5", "vi": "6", "vii": "7", "viii": "8", "ix": "9", "x": "10"}
BUILDING = re.compile(r"(?:^|[\s,.;])([0-9a-z]{1,4})\.?\s*(?:epulet|epul|ep)\b\.?")
STAIRCASE = re.compile(r"(?:^|[\s,.;])([0-9a-z]{1,5})\.?\s*(?:lepcsohaz|lephaz|lph|lh)\b\.?")
SPACED_RANGE = re.compile(r"(?<=\d)\s*[-–—]\s*(?=\d)")
SPACED_SLASH = re.compile(r"(?<=\d)\s*/\s*(?=[a-z0-9])", re.I)
POINTED_LETTER = re.compile(r"(?<=\d)\.(?=[a-z]\b)|(?<=\d) (?=[a-z]\.?$)", re.I)


@functools.lru_cache(CACHED)
def fold(text: str) -> str:
    """Without accents and case."""
    quick = text.casefold().translate(PLAIN)
    if quick.isascii():
        return quick
    return "".join(c for c in unicodedata.normalize("NFKD", text.casefold()) if not unicodedata.combining(c))


def one_error(a: str, b: str, limit: int) -> int:
    """Edit distance with swaps of neighbours (optimal string alignment), or ``limit + 1`` if it is greater."""
    if a == b:
        return 0
    la, lb = len(a), len(b)
    if abs(la - lb) > limit:
        return limit + 1
    k = 0
    while k < min(la, lb) and a[k] == b[k]:
        k += 1
    e = 0
    while e < min(la, lb) - k and a[la - 1 - e] == b[lb - 1 - e]:
        e += 1
    a, b = a[k : la - e], b[k : lb - e]
    if not a or not b:
        return len(a) + len(b)
    if max(len(a), len(b)) > 4 * limit + 4:
        return limit + 1
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            v = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, older[j - 2] + 1)
            row.append(v)
    return min(row[-1], limit + 1)


@functools.lru_cache(CACHED)
def house_parts(text: str) -> tuple[str, str] | None:
    """(number or range, letter) without leading zeros, or None if the text is no house number."""
    m = NUMBER.match(POINTED_LETTER.sub("/", SPACED_SLASH.sub("/", SPACED_RANGE.sub("-", fold(text).strip(" .")))).replace(" ", ""))
    if not m or (m[3] and m[4]):
        return None
    first, last = m[1].lstrip("0"), (m[2] or "").lstrip("0")
    if not first:
        return None
    return (f"{first}-{last}" if last and last != first else first), (m[3] or m[4] or "").lstrip("0").upper()


@functools.lru_cache(CACHED)
def unit(text: str) -> str:
    t = fold(text).strip(" .")
    return t.lstrip("0").upper() if t else ""


@functools.lru_cache(CACHED)
def stair(text: str) -> str:
    t = fold(text).strip(" .")
    return ROMAN.get(t, t.lstrip("0").upper())


@functools.lru_cache(CACHED)
def type_of(word: str) -> str | None:
    w = fold(word).strip(".,")
    if len(w) == 1 and not word.isascii():
        return None  # an abbreviated first word
    if w in TYPE_OF:
        return TYPE_OF[w]
    if len(w) >= 4:
        near = {t for x, t in TYPE_OF.items() if len(x) >= 4 and (x in TYPES or x[0] == w[0]) and one_error(w, x, 1) <= 1}
        return near.pop() if len(near) == 1 else None
    # Of a short word only two neighbours that have changed places are a slip; other errors make other words of it.
    near = {t for x, t in TYPE_OF.items() if len(x) == 3 == len(w) and sorted(x) == sorted(w) and one_error(w, x, 1) == 1}
    return near.pop() if len(near) == 1 else None


@functools.lru_cache(CACHED)
def street_parts(text: str, station: bool = False) -> tuple[str, str | None, str | None]:
    """(street name, street type, house number text) read from a text that may hold all of them in any order."""
    t = POINTED_LETTER.sub("/", SPACED_SLASH.sub("/", SPACED_RANGE.sub("-", re.sub(r"\s+", " ", unicodedata.normalize("NFC", text)).strip())))
    if station:
        t = _address_part(t)
    words = [w for w in re.split(r"[\s,;()]+", t) if w and w.strip("-–.\"'")]
    number = place = None
    for k, w in enumerate(words):
        if w[0].isdigit() and house_parts(w):
            number, place = w.rstrip("."), k
            break
    kind = at = None
    # A type stands last, before the number, or first; the last one that is written counts.
    for k in range(len(words) - 1, -1, -1):
        if k != place and (found := type_of(words[k])) and len(words) > 1:
            if len(fold(words[k]).strip(".")) == 1 and k == (1 if place == 0 else 0) and words[k].endswith(".") and len(words) > k + 1 and type_of(words[-1]):
                continue  # an abbreviated first word
            kind, at = found, k
            break
    # A long type may have grown together with the name before it.
    if kind is None and words:
        k = next((k for k in range(len(words) - 1, -1, -1) if k != place), 0)
        for ending in ("utca", "setany", "lejto"):
            w = words[k].rstrip(".")
            if fold(w).endswith(ending) and len(w) >= len(ending) + 4 and len(fold(w)) == len(w):
                kind, words[k] = ending, w[: -len(ending)]
    name = [w for k, w in enumerate(words) if k not in (place, at) and not (place is not None and w[0].isdigit() and house_parts(w))]
    if station:
        if at is not None and at >= 0 and place == 0 and at > 1:
            name = words[1:at]  # number, street, type, institution
        elif at is not None and at >= 0 and place is not None and place > at > 0:
            name = words[:at]
        kept = [w for w in name if not INSTITUTION.match(fold(w).strip(".").replace(".", ""))]
        name = kept or name
    # A type written twice.
    while len(name) > 1 and kind and type_of(name[-1]) == kind:
        name = name[:-1]
    while len(name) > 1 and kind and type_of(name[0]) == kind and len(fold(name[0]).strip(".")) > 1:
        name = name[1:]
    return " ".join(name), kind, number


def _address_part(t: str) -> str:
    """The part of a station's text that is an address, without the institution."""
    m = re.match(r"^(.*?)\(([^()]*)\)?\s*(.*)$", t)
    if m:
        outer, inner = (m[1] + " " + m[3]).strip(), m[2].strip()
        return inner if _address_like(inner) > _address_like(outer) else outer
    for mark in (r"\s[-–]\s", r","):
        parts = [p.strip() for p in re.split(mark, t) if p.strip()]
        if len(parts) > 1:
            return max(parts, key=_address_like)
    return t


def _address_like(t: str) -> int:
    words = t.split()
    return 2 * any(w[0].isdigit() for w in words) + any(type_of(w) is not None for w in words) - 2 * any(INSTITUTION.match(fold(w).strip(".").replace(".", "")) is not None for w in words)


@functools.lru_cache(CACHED)
def name_parts(name: str) -> tuple[str, str, str, str, str]:
    """(accented, folded, first word, abbreviation, rest of the folded name) of a street name."""
    words = [w for w in re.split(r"[\s\-–]+", name) if w]
    abbreviation, rest = "", ""
    first = fold(words[0]) if words else ""
    if len(words) > 1 and (first.endswith(".") and len(first) <= 5 or len(first) == 1):
        abbreviation = first.strip(".")
        rest = "".join(c for w in words[1:] for c in fold(w) if c.isalnum())
    accented = "".join(c for w in words for c in unicodedata.normalize("NFC", w.casefold()) if c.isalnum())
    folded = "".join(c for w in words for c in fold(w) if c.isalnum())
    head = "".join(c for c in first if c.isalnum()) if len(words) > 1 else ""
    return accented, folded, head, abbreviation, rest


def read_address(street: str, kind: str, house: str, building: str, stairs: str, full: str, mode: str) -> tuple:
    """(accented name, folded name, abbreviation, rest of the folded name, type, number, unit, staircase) of one way of writing."""
    station = mode == "station"
    b, s = unit(building), stair(stairs)
    text = full if mode in ("station", "full") and full else street
    if mode == "full" and full:
        low = fold(full)
        if "l" in low and (m := STAIRCASE.search(low)):
            s, text, low = s or stair(m[1]), text[: m.start()] + " " + text[m.end() :], low[: m.start()] + " " + low[m.end() :]
        if "ep" in low and (m := BUILDING.search(low)):
            b, text = b or unit(m[1]), text[: m.start()] + " " + text[m.end() :]
    name, found, number = street_parts(text, station)
    given = type_of(kind) if kind else None
    h = house_parts(house) if house else None
    if h is None and number:
        h = house_parts(number)
    number, letter = h or ("", "")
    units = "|".join(u for u in (letter, b) if u)
    accented, folded, head, abbreviation, rest = name_parts(name)
    return accented, folded, head, abbreviation, rest, found or given or "", number, units, s


FORM = ("accented", "folded", "head", "abbreviation", "rest", "kind")
PARTS = ("accented", "folded", "head", "abbreviation", "rest", "kind", "number", "unit", "stair")


def penalty(a: tuple, b: tuple) -> float:
    """Dissimilarity of two street forms (accented, folded, head, abbreviation, rest, kind); 9 if they cannot be one street."""
    if a[5] and b[5] and a[5] != b[5]:
        return 9
    cost = 0.25 if a[5] != b[5] else 0.0
    if a[3] or b[3]:
        if not a[3] or (b[3] and len(b[3]) < len(a[3])):
            a, b = b, a
        if b[3]:
            if not (a[3].startswith(b[3]) or b[3].startswith(a[3])):
                return 9
            d = one_error(a[4], b[4], 1)
            return cost + 0.5 + 2 * d if d <= 1 else 9
        best = 9.0
        for size in (len(a[4]), len(a[4]) + 1, len(a[4]) - 1):
            left, right = b[1][: len(b[1]) - size], b[1][len(b[1]) - size :]
            if b[2] and abs(len(left) - len(b[2])) > 1 or not 2 <= len(left) <= 8:
                continue
            d = one_error(a[4], right, 1)
            if left.startswith(a[3]):
                slips = d
            elif len(a[3]) > 1 and a[3][0] == left[0] and min(one_error(a[3], left[:n], 1) for n in (len(a[3]) - 1, len(a[3]), len(a[3]) + 1)) <= 1:
                slips = d + 1  # a slip in the abbreviation
            else:
                continue
            if slips <= 1:
                best = min(best, cost + 0.5 + 2 * slips)
        return best
    d = one_error(a[1], b[1], 1)
    if d == 0:
        if a[0] == b[0]:
            return cost
        return cost + (0.5 if a[0].isascii() or b[0].isascii() else 1.5)
    if d > 1 or min(len(a[1]), len(b[1])) < 4:
        return 9
    return cost + 2 * d


def neighbours(forms: DataFrame, numbered: DataFrame, window: int = WINDOW, anchors: int = ANCHORS, block: int = BLOCK) -> DataFrame:
    """Similar forms of one area, found in four orders: (``a``, ``b``, ``cost``), every pair in both directions.

    A window holds the next ``window`` forms and, but for the order by number, the ``anchors`` nearest common forms on
    either side, however many rare ones crowd between; a form is common if it is complete and seen with at least
    ``ANCHOR_SUPPORT`` numbers. ``numbered``: the distinct (``form_id``, ``number``) that occur, for the order by number.
    """
    short = F.col("abbreviation") != ""
    name = F.when(short, F.col("rest")).otherwise(F.col("folded"))
    last_first = F.when(short, F.concat("rest", "abbreviation")).when(F.col("head") != "", F.concat(F.expr("substring(folded, length(head) + 1)"), "head")).otherwise(F.col("folded"))
    orders = F.array(
        F.struct(F.lit(0).alias("pass"), F.col("folded").alias("sort_key")),
        F.struct(F.lit(1).alias("pass"), F.reverse(name).alias("sort_key")),
        F.struct(F.lit(2).alias("pass"), last_first.alias("sort_key")),
    )
    anchor = (F.col("support") >= ANCHOR_SUPPORT) & ~short & (F.col("kind") != "")
    light = ["form_id", F.when(F.col("kind") != "", F.xxhash64("kind")).otherwise(F.lit(0)).alias("kind"), short.alias("short")]
    by_name = forms.select("area", *light, anchor.alias("anchor"), F.explode(orders).alias("o")).select(F.xxhash64("area", "o.pass").alias("list"), "form_id", "kind", "short", "anchor", "o.sort_key")
    by_number = numbered.where("number != ''").join(forms.hint("merge"), "form_id").select(F.xxhash64("area", F.lit(3), "number").alias("list"), *light, F.lit(False).alias("anchor"), F.col("folded").alias("sort_key"))
    order = ["list", "sort_key", "form_id"]
    ordered = cut(by_name.unionByName(by_number).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id()))
    # Places in the whole order, from those in each partition; one row for each partition is broadcast.
    part = F.shiftright("__id", 33).alias("__part")
    before = ordered.groupBy(part).agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.sum("n").over(Window.orderBy("__part")) - F.col("n")).drop("n")
    placed = ordered.withColumn("__part", part).join(F.broadcast(before), "__part").withColumn("n", F.col("before") + F.col("__id") % (1 << 33)).drop("__part", "before", "__id")
    placed = placed.withColumn("block", F.expr(f"n DIV {block}"))
    # Common forms are numbered too: by their place in the block, and the common ones of the blocks before it.
    total = placed.groupBy("block").agg(F.count_if("anchor").alias("k")).withColumn("first_at", F.sum("k").over(Window.orderBy("block")) - F.col("k"))
    own = placed.withColumn("guest", F.lit(0))
    ahead = placed.where(f"n % {block} < {window} AND block > 0").withColumn("block", F.col("block") - 1).withColumn("guest", F.lit(1))
    stay = placed.where("anchor").withColumn("at", F.row_number().over(Window.partitionBy("block").orderBy("n"))).join(total.select("block", "first_at"), "block")
    stay = stay.withColumn("at", F.col("at") + F.col("first_at")).drop("first_at", "block")
    asked = total.select("block", F.explode(F.concat(F.sequence(F.col("first_at") - anchors + 1, F.col("first_at")), F.sequence(F.col("first_at") + F.col("k") + 1, F.col("first_at") + F.col("k") + anchors))).alias("at"))
    visit = stay.join(asked.hint("merge"), "at").withColumn("guest", F.lit(2)).drop("at")
    columns = ["block", "n", "list", "form_id", "kind", "short", "anchor", "sort_key", "guest"]
    rows = own.select(*columns).unionByName(ahead.select(*columns)).unionByName(visit.select(*columns))

    def meet(t: pd.DataFrame) -> pd.DataFrame:
        return window_pairs(t, window, anchors)

    pairs = rows.groupBy("block").applyInPandas(meet, "a long, b long").distinct()

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            one, two = (list(zip(*(t[f"{side}_{p}"] for p in FORM))) for side in "xy")
            t["cost"] = [penalty(x, y) for x, y in zip(one, two)]
            yield t.loc[t["cost"] < 9, ["a", "b", "cost"]]

    side = lambda x, key: forms.select(F.col("form_id").alias(key), F.col("area").alias(f"{x}_area"), *(F.col(p).alias(f"{x}_{p}") for p in FORM))
    both = pairs.join(side("x", "a").hint("merge"), "a").join(side("y", "b").hint("merge"), "b").where("x_area = y_area")
    scored = cut(both.select("a", "b", *(f"{x}_{p}" for x in "xy" for p in FORM)).mapInPandas(score, "a long, b long, cost double"))
    return scored.unionByName(scored.select(F.col("b").alias("a"), F.col("a").alias("b"), "cost"))


def letter_sets(texts: list[str]) -> np.ndarray:
    """For each text a bit for each letter in it; different letters may share a bit."""
    raw = np.frombuffer(" ".join([*texts, ""]).encode("utf-32-le", "replace"), np.uint32)
    sizes = np.array([len(t) + 1 for t in texts])
    return np.bitwise_or.reduceat(np.uint64(1) << (raw & np.uint32(63)).astype(np.uint64), np.cumsum(sizes) - sizes)


def window_pairs(t: pd.DataFrame, window: int, anchors: int) -> pd.DataFrame:
    """Forms of a block that meet in a window and may be similar by their letters: distinct (``a``, ``b``), a < b."""
    t = t.sort_values("n", kind="stable").reset_index(drop=True)
    t = t.loc[~t.duplicated("n")] if t["n"].duplicated().any() else t  # a guest for two reasons
    n, lists, form, kind, short = (t[c].to_numpy() for c in ("n", "list", "form_id", "kind", "short"))
    anchor, own = t["anchor"].to_numpy(), t["guest"].to_numpy() == 0
    sets, size = letter_sets(t["sort_key"].tolist()), t["sort_key"].str.len().to_numpy()

    def alike(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        m = (lists[i] == lists[j]) & ((kind[i] == kind[j]) | (kind[i] == 0) | (kind[j] == 0)) & (form[i] != form[j])
        i, j = i[m], j[m]
        x, y = sets[i] & ~sets[j], sets[j] & ~sets[i]
        x, y = np.bitwise_count(x), np.bitwise_count(y)
        near = np.where(short[i] | short[j], np.minimum(x, y) <= 2, (x + y <= 2) & (np.abs(size[i] - size[j]) <= 1))
        return np.stack([i[near], j[near]], 1)

    at = np.arange(len(t))
    found = []
    for k in range(1, min(window, len(t) - 1) + 1):
        i = at[:-k]
        i = i[own[i] & (n[i + k] - n[i] == k)]
        found.append(alike(i, i + k))
    common = np.flatnonzero(anchor)
    rare = at[own & ~anchor]
    place = np.searchsorted(n[common], n[rare])
    for d in range(-anchors, anchors):
        m = (place + d >= 0) & (place + d < len(common))
        found.append(alike(rare[m], common[place[m] + d]))
    pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
    a, b = form[pairs[:, 0]], form[pairs[:, 1]]
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()


def resolve_streets(forms: DataFrame, numbered: DataFrame) -> DataFrame:
    """Roots of street forms: (``form_id``, ``root``); several roots if more than one is equally good.

    ``forms``: area, form_id, the form's parts and ``support`` (different numbers seen with it). A form
    follows only forms that rank above it (more support, then more complete), so there are no circles;
    a slip of the pen is followed only if the form is rare beside the other.
    """
    rank = forms.select(F.col("form_id"), F.col("support"), F.struct("support", ((F.col("kind") != "").cast("int") + (F.col("abbreviation") == "").cast("int")).alias("complete"), "form_id").alias("rank"))
    near = neighbours(forms, numbered)
    ra = rank.select(F.col("form_id").alias("a"), F.col("support").alias("sa"), F.col("rank").alias("ra"))
    rb = rank.select(F.col("form_id").alias("b"), F.col("support").alias("sb"), F.col("rank").alias("rb"))
    # These tables grow with the data: they are small in their files, so a guess by file size would send them to all tasks.
    edges = near.join(ra.hint("merge"), "a").join(rb.hint("merge"), "b")
    slip = F.col("cost") >= 1.5
    up = edges.where((F.col("ra") < F.col("rb")) & (~slip | (F.col("sa") <= F.greatest(F.lit(2), F.col("sb") / 8))))
    best = cut(up.withColumn("least", F.min("cost").over(Window.partitionBy("a"))).where("cost <= least + 0.01").select("a", "b").distinct())
    # Variants of variants are led to their roots, each step twice as far, until none has a way to go.
    while True:
        further = best.join(best.select(F.col("a").alias("b"), F.col("b").alias("c")).hint("merge"), "b", "left")
        if further.where("c IS NOT NULL").isEmpty():
            break
        best = cut(further.select("a", F.coalesce("c", "b").alias("b")).distinct())
    return forms.select("form_id").join(best.withColumnRenamed("a", "form_id").hint("merge"), "form_id", "left").select("form_id", F.coalesce("b", "form_id").alias("root"))


def same_places(records: DataFrame) -> DataFrame:
    """Place of each record: (``kind_of_record``, ``id``, ``place``), for records whose place another may share.

    ``records``: ``kind_of_record``, ``id``, ``area``, ``mode`` (how to read it), and the texts ``street``, ``street_type``,
    ``house``, ``building``, ``stairs``, ``full``; all text, none null. Records without any street name have no place.
    Records with one id in one kind count once.
    """
    texts = ["mode", "street", "street_type", "house", "building", "stairs", "full"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            t = t.loc[~t.duplicated()]  # repeated rows of a batch
            memo: dict[tuple, tuple] = {}
            out = []
            for m, a, b, c, d, e, f in zip(*(t[x] for x in texts)):
                key = (a, b, c, d, e, f, m)
                if key not in memo:
                    memo[key] = read_address(*key)
                out.append(memo[key])
            got = pd.DataFrame(out, columns=PARTS) if out else pd.DataFrame({p: pd.Series(dtype=str) for p in PARTS})
            yield pd.concat([t[["kind_of_record", "id", "area"]].reset_index(drop=True), got], axis=1)

    schema = "kind_of_record string, id string, area string, " + ", ".join(f"{p} string" for p in PARTS)
    parsed = records.mapInPandas(read, schema).where("folded != ''")
    form_of = F.xxhash64("area", "accented", "abbreviation", "rest", "kind")
    parsed = cut(parsed.withColumn("form_id", form_of).withColumn("spot", F.concat_ws("/", "number", "unit", "stair")))
    numbered = cut(parsed.select("form_id", "number").distinct())
    own = ["form_id", "area", "accented", "folded", "abbreviation", "rest", "kind"]
    forms = parsed.select(*own, "head").distinct().groupBy(*own).agg(F.max("head").alias("head")).join(numbered.groupBy("form_id").agg(F.count(F.lit(1)).alias("support")), "form_id")
    roots = resolve_streets(cut(forms), numbered)
    options = roots.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("form_id")))
    joined = cut(parsed.select("kind_of_record", "id", "form_id", "number", "spot").join(options.hint("merge"), "form_id"))
    sure = joined.where("n = 1").select("kind_of_record", "id", "root", "number", "spot")
    # With several streets to choose from, the one that has such a place decides, if it is the only one.
    places = sure.where("number != ''").select("root", "spot").distinct()
    open_ = joined.where("n > 1 AND number != ''").join(places.hint("merge"), ["root", "spot"], "left_semi")
    told = open_.groupBy("kind_of_record", "id", "number", "spot").agg(F.min("root").alias("root"), F.count_distinct("root").alias("n")).where("n = 1").select("kind_of_record", "id", "root", "number", "spot")
    known = cut(sure.unionByName(told))
    # A number left out: the street's only place, within records of that kind; of several none can be meant.
    ends = known.where("number != ''").groupBy("kind_of_record", "root").agg(F.min("spot").alias("low"), F.max("spot").alias("high"))
    bare = known.where("number = ''").join(ends.hint("merge"), ["kind_of_record", "root"], "left").where("low IS NULL OR low = high").withColumn("spot", F.coalesce("low", F.lit("")))
    every = known.where("number != ''").select("kind_of_record", "id", "root", "spot").unionByName(bare.select("kind_of_record", "id", "root", "spot"))
    return cut(every.select("kind_of_record", "id", F.xxhash64("root", "spot").alias("place")).distinct())


def pairs_of(places: DataFrame) -> DataFrame:
    """Pairs of records of one kind at one place: (``pair_kind``, ``id_a``, ``id_b``), the smaller id first."""
    a = places.select("kind_of_record", "place", F.col("id").alias("id_a"))
    b = places.select("kind_of_record", "place", F.col("id").alias("id_b"))
    return a.join(b, ["kind_of_record", "place"]).where("id_a < id_b").select(F.col("kind_of_record").alias("pair_kind"), "id_a", "id_b").distinct()


def area_of(county: Column, settlement: Column) -> Column:
    """County code and settlement name without case and accents."""
    plain = F.translate(F.lower(blank_to_empty(settlement)), "áéíóöőúüűäß", "aeiooouuuas")
    return F.concat_ws("|", blank_to_empty(county), F.regexp_replace(plain, r"[\s\-–.]+", ""))


def address_records(staging: DataFrame, canonical: DataFrame, mapping: DataFrame, stations: DataFrame) -> DataFrame:
    """Records of the three kinds in the form that ``same_places`` reads.

    ``gate``: records of the last run that have a gate code; ``canonical``: records that no mapping names as
    original; ``station``: all stations. Other canonical records are read along under a kind of their own
    (``mapped``), so that streets they write in full help the others.
    """
    text = lambda c: blank_to_empty(F.col(c).cast("string"))
    none = F.lit("")
    tags = [r[0] for r in staging.select("run_tag").distinct().collect() if r[0] is not None]  # one short text for each delivery
    bare = {r["raw"]: r["tag"] for r in staging.sparkSession.createDataFrame([(x,) for x in tags], "raw string").select("raw", blank_to_empty("raw").alias("tag")).collect()}
    last = [x for x in tags if bare[x] and bare[x] == max(bare.values())]
    gate = (
        staging.where(F.col("run_tag").isin(last))
        .select(F.lit("gate").alias("kind_of_record"), text("gate_code").alias("id"), area_of(F.col("county_code"), F.col("settlement_name")).alias("area"), F.lit("parts").alias("mode"),
                text("street_name").alias("street"), text("street_type").alias("street_type"), text("house_number").alias("house"), text("building").alias("building"), text("staircase").alias("stairs"), none.alias("full"))
        .where("id != ''")
    )
    mapped = mapping.select(F.col("original_address_id").alias("id")).where("id IS NOT NULL").distinct().withColumn("is_mapped", F.lit(True))
    canon = (
        canonical.where("id IS NOT NULL").join(mapped, "id", "left")
        .select(F.when(F.col("is_mapped"), F.lit("mapped")).otherwise(F.lit("canonical")).alias("kind_of_record"), F.col("id").cast("string").alias("id"), area_of(F.col("county_code"), F.col("settlement_name")).alias("area"), F.lit("full").alias("mode"),
                text("street_name").alias("street"), none.alias("street_type"), text("house_number").alias("house"), text("building").alias("building"), text("staircase").alias("stairs"), text("full_address").alias("full"))
    )
    station = stations.where("id IS NOT NULL").select(
        F.lit("station").alias("kind_of_record"), F.col("id").cast("string").alias("id"), F.concat(F.lit("station|"), F.lower(blank_to_empty("settlement_id"))).alias("area"), F.lit("station").alias("mode"),
        none.alias("street"), none.alias("street_type"), none.alias("house"), none.alias("building"), none.alias("stairs"), text("polling_station_address").alias("full"),
    ).where("full != ''")
    return gate.unionByName(canon).unionByName(station)


def address_classes(staging: DataFrame, canonical: DataFrame, mapping: DataFrame, stations: DataFrame) -> DataFrame:
    """The place of every record that has one: distinct (``kind_of_record``, ``id``, ``place``).

    Records of one kind with one place are the same place. Nulls and blanks are parts that are not given; records
    without street name, gate code or id have no place; repeated rows count once; an id with several versions is at
    each version's place; empty tables give no rows. Only the named columns are read, so others may have any name.
    """
    return same_places(address_records(staging, canonical, mapping, stations)).where("kind_of_record != 'mapped'")


def address_pairs(staging: DataFrame, canonical: DataFrame, mapping: DataFrame, stations: DataFrame) -> DataFrame:
    """The places of ``address_classes`` written out as pairs of records of the same kind.

    Result: distinct (``pair_kind``, ``id_a``, ``id_b``), the smaller id (as text) first. A place with very many records
    has very many pairs; what goes on with places should take the classes.
    """
    return pairs_of(address_classes(staging, canonical, mapping, stations))
