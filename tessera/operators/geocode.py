"""Coordinates from a cache and from other addresses: classification, merging, interpolation, matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.textops import byte_similarity, folded, station_street, without_parentheses
from tessera.operators.tables import first_by, last_by
from tessera.session import cut, strip

# Rank of qualities where a better one replaces a worse one; others count 0.
QUALITY_RANK = {"exact": 3, "street": 2, "settlement": 1, "failed": 0}


def quality_rank(c: Column) -> Column:
    out = F.lit(0)
    for name, rank in QUALITY_RANK.items():
        out = F.when(c == name, rank).otherwise(out)
    return out


def quality_of_osm(kind: Column, place_class: Column, rank: Column) -> Column:
    """Quality of a map object by its kind, class and search rank (30 if missing). The names and ranks are fixed values."""
    r = F.coalesce(rank, F.lit(30))
    return (
        F.when((F.coalesce(kind, F.lit("")) == "house") | (r == 30), "exact")
        .when(F.coalesce(place_class, F.lit("")).isin("highway", "street") | (r == 26), "street")
        .when((F.coalesce(place_class, F.lit("")) == "place") | (r < 20), "settlement").otherwise("street")
    )


def quality_of_result_type(result_type: Column, house: Column, street: Column, city: Column) -> Column:
    """Quality of a lookup service's answer by its result type, then by the fields it filled. The names are fixed values."""
    return (
        F.when(result_type.isin("houseNumber", "place"), "exact").when(result_type.isin("street", "intersection"), "street")
        .when(result_type.isin("locality", "administrativeArea", "district", "postalCodePoint"), "settlement")
        .when(house.isNotNull(), "exact").when(street.isNotNull(), "street").when(city.isNotNull(), "settlement").otherwise("street")
    )


def quality_by_keyword(kind: Column) -> Column:
    """Quality by keywords of an answer's kind: a house, a street or road, a place; anything else has failed."""
    k = F.lower(F.coalesce(kind, F.lit("")))
    return (
        F.when(k.rlike("house|building"), "exact").when(k.rlike("street|road"), "street")
        .when(k.rlike("city|town|village|place"), "settlement").otherwise("failed")
    )


def answer_place(answer: Column) -> Column:
    """Place of a lookup service's answer in JSON: coordinates, kind and quality of its first item; nulls if there is none."""
    one = "struct<resultType:string,position:struct<lat:double,lng:double>,address:struct<houseNumber:string,street:string,city:string>>"
    item = F.get(F.from_json(answer, f"struct<items:array<{one}>>")["items"], 0)
    at, a = item["position"], item["address"]
    quality = F.when(item.isNotNull(), quality_of_result_type(item["resultType"], a["houseNumber"], a["street"], a["city"]))
    return F.struct(at["lat"].alias("latitude"), at["lng"].alias("longitude"), item["resultType"].alias("kind"), quality.alias("quality"))


def wants_retry(quality: Column, minimum: Column) -> Column:
    """Whether an address should be looked up again: failed ones always, others if they are worse than the configured minimum."""
    m = F.coalesce(minimum, F.lit(""))
    return (
        (quality == "failed") | ((quality == "settlement") & m.isin("settlement", "street", "exact")) | ((quality == "street") & m.isin("street", "exact"))
    )


def crowded_points(points: DataFrame, key: str, lat: str, lon: str, more_than: int = 10) -> DataFrame:
    """Points that more than so many keys share: the coordinates and ``n``."""
    return points.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).groupBy(lat, lon).agg(F.count_distinct(key).alias("n")).where(F.col("n") > more_than)


def cache_hits(addresses: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """Addresses with the coordinates that a cache holds for their key; failed look-ups are no hits. One cache row for each key."""
    hit = cache.where("quality != 'failed'").select(key, "latitude", "longitude", "quality", F.lit("cache").alias("source"))
    return addresses.join(hit, key)


def cache_misses(addresses: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """Addresses whose key has no usable cache row."""
    return addresses.join(cache.where("quality != 'failed'").select(key), key, "left_anti")


def better_wins(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Old rows, with the new row's columns where its quality ranks strictly above. One new row for each key."""
    n = new.select(key, *(F.col(c).alias(f"__{c}") for c in [*columns, "quality"]))
    j = old.join(n, key, "left")
    better = quality_rank(F.col("__quality")) > quality_rank(F.col("quality"))
    return j.select(*(F.when(better, F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in (*columns, "quality") else F.col(c) for c in old.columns))


def interpolate(df: DataFrame, group: list[str], number: str, lat: str, lon: str, quality: str, row_id: str) -> DataFrame:
    """Coordinates for ``street`` rows from the exact rows around them in their group.

    At least two exact rows with a number are needed. Between two: linear by number. Above the last: 0.0001
    degrees a number on both axes. Below the first: its point. Rows with equal numbers go by ``row_id``.
    Result: ``row_id``, ``new_latitude``, ``new_longitude``, ``new_source``, ``new_quality`` (``interpolated``).
    """
    exact = F.when((F.col(quality) == "exact") & F.col(number).isNotNull() & F.col(lat).isNotNull() & F.col(lon).isNotNull(), F.struct(F.col(number).alias("n"), F.col(lat).alias("lat"), F.col(lon).alias("lon")))
    rows = df.where(F.col(number).isNotNull()).withColumn("__e", exact)
    # Of exact rows with one number the last by row id stands below, the first above.
    per = rows.groupBy(*group, number).agg(F.max_by("__e", F.when(F.col("__e").isNotNull(), F.col(row_id))).alias("__last"), F.min_by("__e", F.when(F.col("__e").isNotNull(), F.col(row_id))).alias("__first"), F.count("__e").alias("__k"))
    w = Window.partitionBy(*group).orderBy(number)
    brackets = (
        per.withColumn("lo", F.last("__last", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("hi", F.first("__first", ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)))
        .withColumn("__total", F.sum("__k").over(Window.partitionBy(*group))).where("__total >= 2").select(*group, number, "lo", "hi")
    )
    t = rows.where(F.col(quality) == "street").select(*group, number, row_id).join(brackets, [*group, number])
    n = F.col(number)
    share = F.when(F.col("hi.n") > F.col("lo.n"), (n - F.col("lo.n")) / (F.col("hi.n") - F.col("lo.n"))).otherwise(F.lit(0.0))

    def axis(c: str) -> Column:
        between = F.col(f"lo.{c}") + share * (F.col(f"hi.{c}") - F.col(f"lo.{c}"))
        above = F.col(f"lo.{c}") + 0.0001 * (n - F.col("lo.n"))
        return F.when(F.col("lo").isNotNull() & F.col("hi").isNotNull(), between).when(F.col("lo").isNotNull(), above).otherwise(F.col(f"hi.{c}"))

    source = (
        F.when(F.col("lo").isNotNull() & F.col("hi").isNotNull(), F.concat(F.lit("interpolated ("), F.col("lo.n").cast("string"), F.lit("-"), F.col("hi.n").cast("string"), F.lit(")")))
        .otherwise(F.concat(F.lit("extrapolated (nearest: "), F.coalesce("lo.n", "hi.n").cast("string"), F.lit(")")))
    )
    return t.where("lo IS NOT NULL OR hi IS NOT NULL").select(row_id, axis("lat").alias("new_latitude"), axis("lon").alias("new_longitude"), source.alias("new_source"), F.lit("interpolated").alias("new_quality"))


TIERS = (0.8,)  # similarities at which the search for the best stops, if it has found one
# Letters from rare to common, for the order of tokens; it has a say in the number of candidates only.
COMMON = "qxwyjfpuhcvbdgzmisoknrlate"


def _rare_tokens(text: Column, least: float) -> Column:
    """The rarest letters of a text, told apart by how often they came before; two texts as similar as ``least`` share one of them.

    Texts at a distance d share all but d letters of the longer one; so of the letters in one order the first
    n - least * n + 1 of each cannot all be missing in the other.
    """
    letters = F.array_sort(F.filter(F.split(text, ""), lambda c: c != ""))
    tokens = F.transform(letters, lambda c, i: F.struct((-(i - F.array_position(letters, c))).alias("again"), F.instr(F.lit(COMMON), c).alias("common"), c.alias("letter")))
    return F.transform(F.slice(F.array_sort(tokens), 1, (F.size(letters) - F.ceil(F.size(letters) * least - 1e-9) + 1).cast("int")), lambda t: F.concat(t["letter"], t["again"].cast("string")))


def best_fuzzy(left: DataFrame, right: DataFrame, block: str, left_text: str, right_text: str, left_id: str, right_id: str, least: float = 0.6) -> DataFrame:
    """For each left row the most similar right row of its block, from ``least`` on; of equals the smallest id.

    The texts of a block are compared once each: equal texts are collapsed to their smallest id first. Texts are not
    held against all of their block: they meet if they share a rare letter and are about as long as each other,
    which no two similar texts miss. Texts that have an equal partner, and then those that have a very similar one, are done
    before looser similarities are looked for.
    """
    raw = lambda c: F.decode(F.encode(F.lower(c), "UTF-8"), "ISO-8859-1")
    a = left.select(F.col(block).alias("__block"), F.col(left_id).alias("left_id"), F.col(left_text).alias("__a"))
    b = right.groupBy(F.col(block).alias("__block"), F.col(right_text).alias("__b")).agg(F.min(right_id).alias("right_id")).where("__b IS NOT NULL")
    b, todo = cut(b), cut(a.where("__a IS NOT NULL").select("__block", "__a").distinct())
    equal = todo.where("__a != ''").withColumn("__l", F.lower("__a")).join(b.select("__block", F.lower("__b").alias("__l"), "right_id"), ["__block", "__l"])
    found = cut(equal.groupBy("__block", "__a").agg(F.min(F.struct(F.lit(-1.0).alias("s"), "right_id")).alias("m")))
    todo = todo.join(found, ["__block", "__a"], "left_anti")
    for tier in [t for t in TIERS if t > least] + [least]:
        one = todo.withColumn("token", F.explode(_rare_tokens(raw(F.col("__a")), tier)))
        two = b.withColumn("token", F.explode(_rare_tokens(raw(F.col("__b")), tier)))
        longest = F.greatest(F.length(raw(F.col("__a"))), F.length(raw(F.col("__b"))))
        close = F.least(F.length(raw(F.col("__a"))), F.length(raw(F.col("__b")))) >= longest * tier - 1e-9
        pairs = one.join(two, ["__block", "token"]).where(close).drop("token").distinct().withColumn("similarity", byte_similarity(F.col("__a"), F.col("__b"))).where(F.col("similarity") >= tier)
        best = pairs.groupBy("__block", "__a").agg(F.min(F.struct((-F.col("similarity")).alias("s"), "right_id")).alias("m"))
        if tier != least:
            best = cut(best)
            todo = todo.join(best, ["__block", "__a"], "left_anti")
        found = found.unionByName(best)
    return a.join(found, ["__block", "__a"]).select("left_id", F.col("m.right_id").alias("right_id"), (-F.col("m.s")).alias("similarity"))


PLACE = ("quality", "source", "matched_id", "similarity", "latitude", "longitude")


def fallback(rows: DataFrame, key: str, candidates: list[DataFrame]) -> DataFrame:
    """The keys of ``rows`` with the place of the first of ``candidates`` that has one for them, tried in the order given.

    Candidates hold ``key`` and the columns ``PLACE``; those without both coordinates, or that failed, are none. Of
    several in one table the smallest ``matched_id`` is taken, then the smallest coordinates. A key without any is
    given as ``failed``, without coordinates.
    """
    all_of = None
    for rung, c in enumerate(candidates):
        one = c.where("latitude IS NOT NULL AND longitude IS NOT NULL AND quality != 'failed'").select(F.lit(rung).alias("__rung"), key, *PLACE)
        all_of = one if all_of is None else all_of.unionByName(one)
    top = all_of.groupBy(key).agg(F.min(F.struct("__rung", F.coalesce("matched_id", F.lit("")).alias("__m"), "latitude", "longitude", *PLACE[:4])).alias("t"))
    found = rows.select(key).distinct().join(top, key, "left")
    return found.select(key, F.coalesce("t.quality", F.lit("failed")).alias("quality"), *(F.col(f"t.{c}").alias(c) for c in PLACE[1:]))


def station_places(stations: DataFrame, settlements: DataFrame, counties: DataFrame, canonical: DataFrame, least: float = 0.6) -> DataFrame:
    """Where each polling station is: its own coordinates, else those of a canonical address of its settlement, else the settlement's centre.

    Canonical addresses are those of quality exact or street with coordinates, of the station's settlement in its
    county. Tried in order: the whole address, then the street and number in it, equal but for case, accents and
    signs; then the most similar full address, from ``least`` on; then the mean of the settlement's points. Of several
    deliveries of a station, settlement or county the last counts. A station whose county is not known is put into the
    settlement's county, or into the only county whose canonical addresses have the settlement's name.
    """
    ref = lambda c: F.nullif(F.lower(strip(c)), F.lit(""))
    st = last_by(stations.select("id", "loaded_at", "polling_station_address", "latitude", "longitude", ref("settlement_id").alias("sid"), ref("county_id").alias("cid")).where("id IS NOT NULL"), ["id"], ["loaded_at"])
    se = last_by(settlements.select(ref("id").alias("sid"), "loaded_at", folded("settlement_name").alias("name"), ref("county_id").alias("scid")), ["sid"], ["loaded_at"]).drop("loaded_at")
    co = last_by(counties.select(ref("id").alias("cid"), "loaded_at", strip("county_code").alias("code")), ["cid"], ["loaded_at"]).drop("loaded_at")
    usable = canonical.where("id IS NOT NULL AND geocoding_quality IN ('exact', 'street') AND latitude IS NOT NULL AND longitude IS NOT NULL AND NOT isnan(latitude) AND NOT isnan(longitude)")
    place = usable.select(F.col("id").alias("matched_id"), strip("county_code").alias("code"), folded("settlement_name").alias("name"), "full_address", F.col("geocoding_quality").alias("quality"), "latitude", "longitude")
    place = first_by(place, ["matched_id"], [F.asc("quality"), F.asc("latitude"), F.asc("longitude"), F.asc("full_address"), F.asc("code"), F.asc("name")])  # exact before street
    only = place.groupBy("name").agg(F.min("code").alias("only"), F.count_distinct("code").alias("n")).where("n = 1").drop("n")
    st = st.join(se, "sid", "left").join(co, "cid", "left").join(co.select(F.col("cid").alias("scid"), F.col("code").alias("scode")), "scid", "left").join(only, "name", "left")
    area = F.concat(F.coalesce("code", "scode", "only"), F.lit("|"), "name")
    st = st.select("id", "latitude", "longitude", area.alias("area"), without_parentheses("polling_station_address").alias("address"))
    place = place.withColumn("area", F.concat("code", F.lit("|"), "name"))
    own = st.where("latitude IS NOT NULL AND longitude IS NOT NULL AND NOT isnan(latitude) AND NOT isnan(longitude)")
    todo = st.join(own.select("id"), "id", "left_anti").select("id", "area", "address")
    spot = lambda df, source, similarity: df.select("id", "quality", F.lit(source).alias("source"), "matched_id", similarity.alias("similarity"), "latitude", "longitude")
    keyed = lambda df, text: df.where(f"{text} != ''").withColumn("whole", F.nullif(folded(text), F.lit(""))).withColumn("parts", F.nullif(folded(station_street(text)), F.lit("")))
    asked, known = keyed(todo, "address"), keyed(place, "full_address").drop("id")
    equal = [spot(asked.select("id", "area", k).join(known, ["area", k]), f"canonical_{k}", F.lit(1.0)) for k in ("whole", "parts")]
    near = best_fuzzy(asked, known, "area", "address", "full_address", "id", "matched_id", least)
    near = near.select(F.col("left_id").alias("id"), F.col("right_id").alias("matched_id"), "similarity").join(place, "matched_id")
    centre = place.groupBy("area").agg((F.sum(F.col("latitude").cast("decimal(18,10)")).cast("double") / F.count(F.lit(1))).alias("latitude"), (F.sum(F.col("longitude").cast("decimal(18,10)")).cast("double") / F.count(F.lit(1))).alias("longitude"))
    centre = todo.join(centre, "area").withColumn("quality", F.lit("settlement")).withColumn("matched_id", F.lit(None).cast("string"))
    none = F.lit(None).cast("double")
    own = own.withColumn("quality", F.lit("exact")).withColumn("matched_id", F.lit(None).cast("string"))
    return fallback(st, "id", [spot(own, "station", none), *equal, spot(near, "canonical_similar", F.round("similarity", 6)), spot(centre, "settlement_centroid", none)])
