"""Tables to be exported: addresses with all their keys, canonical addresses for serving, tables in another store's shape, closed subsets."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.geo import swapped
from tessera.functions.keys import md5_16, uuid3, uuid5
from tessera.functions.textops import clean_zero_field, export_score, snake_case_text, trim_zeros_export
from tessera.operators.tables import with_sequence

NIL = "00000000-0000-0000-0000-000000000000"


def address_facts(staging: DataFrame, row_id: str = "row_id", order: tuple[str, ...] = ("run_tag", "row_id"), chunk: int = 1000) -> DataFrame:
    """Original addresses, one for each staging row, with the keys of all that they refer to.

    ``original_order`` numbers the rows through, ``sequence`` within chunks of them. Keys of blank parts are null.
    """
    parts = ["county_code", "settlement_code", "oevk_code", "tevk_code", "postal_code", "street_name", "street_type", "house_number", "building", "staircase", "polling_station_address"]
    numbered = with_sequence(staging.select(*dict.fromkeys([row_id, *order, *parts])), list(order), "original_order").withColumn("sequence", (F.col("original_order") - 1) % chunk + 1)
    t = lambda c: F.trim(F.coalesce(c, F.lit("")))
    given = lambda c, key: F.when(t(c) != "", key)
    county, settlement, oevk, tevk = t("county_code"), t("settlement_code"), t("oevk_code"), F.coalesce(F.nullif(t("tevk_code"), F.lit("")), F.lit("-"))
    postal = t("postal_code")
    return numbered.select(
        F.col(row_id).cast("string").alias("id"), "sequence", "original_order",
        t("street_name").alias("space_name"), t("street_type").alias("space_type"), t("house_number").alias("house_number"), t("building").alias("building"), t("staircase").alias("staircase"),
        given("county_code", md5_16(county)).alias("county_id"), given("settlement_code", md5_16(county, settlement)).alias("settlement_id"),
        given("street_name", md5_16(t("street_name"))).alias("space_name_id"), given("street_type", md5_16(t("street_type"))).alias("space_type_id"),
        given("oevk_code", md5_16(county, oevk)).alias("oevk_id"), given("settlement_code", md5_16(county, settlement, tevk)).alias("tevk_id"),
        F.when(~postal.isin("", "0"), postal).alias("postal_code"), F.when(~postal.isin("", "0"), md5_16(postal)).alias("postal_code_id"),
        given("polling_station_address", md5_16(county, settlement, oevk, tevk, t("polling_station_address"))).alias("polling_station_id"),
    )


WIDE_KEYS = ("county_id", "settlement_id", "space_name_id", "space_type_id", "oevk_id", "tevk_id", "postal_code_id", "polling_station_id")


def canonical_wide(canonical: DataFrame, mapping: DataFrame, addresses: DataFrame, stations: DataFrame, counties: DataFrame, settlements: DataFrame) -> DataFrame:
    """Canonical addresses with their place and eight resolved keys; those that lack any of the keys are left out.

    ``canonical``: ``canonical_address_id``, ``county_code``, ``settlement_name``, ``house_number``, ``building``, ``staircase``,
    ``full_address`` and, if there, ``latitude``, ``longitude``, ``geocoding_quality``, ``geocoding_source``. County and settlement are found
    by code and name; of the originals' other keys the smallest is taken, all in one aggregation. Identifiers are
    exported as UUIDs of version 5. A name that a county has twice gives a row for each.
    """
    low = [k for k in WIDE_KEYS if k not in ("county_id", "settlement_id", "polling_station_id")]
    pairs = mapping.select("canonical_address_id", F.col("original_address_id").alias("id")).distinct()
    keys = pairs.join(addresses.select("id", *low), "id").groupBy("canonical_address_id").agg(*(F.min(k).alias(k) for k in low))
    station = stations.groupBy("canonical_address_id").agg(F.min("polling_station_id").alias("polling_station_id"))
    county = counties.select("county_code", F.col("id").alias("county_id")).distinct()
    settlement = settlements.select(F.col("county_id"), "settlement_name", F.col("id").alias("settlement_id")).distinct()
    place = [F.col(c) if c in canonical.columns else F.lit(None).cast(k).alias(c) for c, k in (("latitude", "double"), ("longitude", "double"), ("geocoding_quality", "string"), ("geocoding_source", "string"))]
    own = canonical.select("canonical_address_id", "county_code", "settlement_name", "house_number", "building", "staircase", "full_address", *place)
    whole = own.join(county, "county_code").join(settlement, ["county_id", "settlement_name"]).join(keys, "canonical_address_id").join(station, "canonical_address_id")
    kept = ["house_number", "building", "staircase", "full_address", "latitude", "longitude", "geocoding_quality", "geocoding_source"]
    return whole.dropna(subset=list(WIDE_KEYS)).select(uuid5("canonical_address_id").alias("id"), *kept, *(uuid5(k).alias(k) for k in WIDE_KEYS))


def canonical_served(canonical: DataFrame, mapping: DataFrame, addresses: DataFrame, postal_codes: DataFrame, stations: DataFrame) -> DataFrame:
    """Canonical addresses as they are served by settlement: one row each, whatever is missing.

    Street type, units, districts, county and settlement come from the best written original (export score, then the
    smallest id), the postal code is the one of the smallest code, the station the smallest; ``sequence`` and
    ``original_order`` are the smallest of the originals, 0 without any. Keys that are missing are those of the nil
    identifier; all are exported as UUIDs of version 3.
    """
    pairs = mapping.select("canonical_address_id", F.col("original_address_id").alias("id")).distinct()
    rest = ["space_type", "building", "staircase", "tevk_id", "county_id", "settlement_id", "oevk_id"]
    known = addresses.select("id", "sequence", "original_order", (-export_score("house_number", "building", "staircase")).alias("score"), *rest).withColumn("held", F.lit(True))
    best = pairs.join(known, "id", "left").groupBy("canonical_address_id").agg(
        F.min("sequence").alias("sequence"), F.min("original_order").alias("original_order"), F.count_distinct("id").alias("n_originals"),
        F.min(F.when(F.col("held"), F.struct("score", "id", *rest))).alias("b"),
    )
    postal = postal_codes.groupBy("canonical_address_id").agg(F.min(F.struct("postal_code", "postal_code_id"))["postal_code_id"].alias("postal_code_id"))
    station = stations.groupBy("canonical_address_id").agg(F.min("polling_station_id").alias("polling_station_id"))
    j = canonical.join(best, "canonical_address_id", "left").join(postal, "canonical_address_id", "left").join(station, "canonical_address_id", "left")
    key = lambda c, name: uuid3(F.coalesce(c, F.lit(NIL))).alias(name)
    unit = lambda c: clean_zero_field(trim_zeros_export(F.col(f"b.{c}"))).alias(c)
    return j.select(
        uuid3("canonical_address_id").alias("id"), "settlement_name", F.coalesce("sequence", F.lit(0)).cast("long").alias("sequence"), F.coalesce("original_order", F.lit(0)).cast("long").alias("original_order"), "full_address",
        F.coalesce("street_name", F.lit("")).alias("space_name"), F.coalesce("b.space_type", F.lit("")).alias("space_type"), trim_zeros_export("house_number").alias("house_number"), unit("building"), unit("staircase"),
        key(F.col("postal_code_id"), "postal_code_id"), key(F.col("polling_station_id"), "polling_station_id"), *(key(F.col(f"b.{c}"), c) for c in ("tevk_id", "county_id", "settlement_id", "oevk_id")),
        F.coalesce("n_originals", F.lit(0)).alias("n_originals"),
    )


@dataclass(frozen=True)
class Exported:
    """A table as another store wants it: what it refers to, columns that get other names, columns left out."""

    name: str
    refers_to: tuple[str, ...] = ()
    renamed: dict[str, str] = field(default_factory=dict)
    dropped: tuple[str, ...] = ("created_at", "geocoded_at", "loaded_at", "deleted_at", "updated_at")


# The tables in an order in which every table comes after those it refers to.
EXPORTED = (
    Exported("county", (), {"county_code": "code", "county_name": "name"}),
    Exported("settlement", ("county",), {"settlement_code": "code", "settlement_name": "name"}),
    Exported("national_individual_electoral_district", ("county",), {"oevk": "code", "district_name": "name", "center": "center_wkt", "polygon": "polygon_wkt"}),
    Exported("settlement_individual_electoral_district", ("county", "settlement"), {"tevk": "code", "district_name": "name"}),
    Exported("postal_code", (), {"postal_code": "code"}),
    Exported("postal_code_settlement", ("postal_code", "settlement")),
    Exported("polling_station", ("county", "settlement", "national_individual_electoral_district", "settlement_individual_electoral_district"), {"polling_station_code": "code", "polling_station_address": "address"}),
    Exported("public_space_name", (), {"public_space_name": "name"}),
    Exported("public_space_type", (), {"public_space_type": "name"}),
    Exported("settlement_public_spaces", ("settlement", "public_space_name", "public_space_type")),
    Exported("address_polling_stations", ("polling_station",), {"canonical_address_id": "address_id"}),
    Exported("address_pir_codes", (), {"canonical_address_id": "address_id"}),
    Exported("canonical_address"),
    Exported("address_mapping"),
)


def split_part(c: Column, mark: str, n: int) -> Column:
    """The ``n``-th part of a text, from the end if ``n`` is negative; empty if there are not so many."""
    return F.split_part(c, F.lit(mark), F.lit(n))


def closed_ring(c: Column) -> Column:
    """A polygon text as well-known text without any check: numbers exchanged, the first point added where the last is another."""
    first = split_part(c, ",", 1)
    points = swapped(c)
    ring = F.when(first == split_part(c, ",", -1), points).otherwise(F.concat(points, F.lit(","), swapped(first)))
    return F.when(c.isNotNull(), F.concat(F.lit("POLYGON(("), ring, F.lit("))")))


def as_exported(df: DataFrame, table: Exported) -> DataFrame:
    """A table's columns under the other store's names (snake case), ids as UUIDs of version 5, geometry as well-known text, times left out."""
    out = []
    for c in df.columns:
        snake = snake_case_text(c)
        if snake in table.dropped:
            continue
        name = table.renamed.get(snake, snake)
        col = F.col(f"`{c}`")
        if snake == "id" or snake.endswith("_id") and snake != "osm_id":
            col = uuid5(col)
        elif name == "center_wkt":
            col = F.when(col.isNotNull(), F.concat(F.lit("POINT("), split_part(col, " ", 2), F.lit(" "), split_part(col, " ", 1), F.lit(")")))
        elif name == "polygon_wkt":
            col = closed_ring(col)
        out.append(col.alias(name))
    return df.select(*out)


def closed_subset(tables: dict[str, DataFrame], settlements: DataFrame) -> dict[str, DataFrame]:
    """Every table restricted to what belongs to the chosen settlements (column ``id``), so that no reference leads out of the subset.

    Tables that have a ``settlement_id`` keep its rows; counties and districts are those of the settlements' counties;
    originals are addresses of the settlements, and mappings, canonical addresses and their links are kept if any of
    their originals is. Every restriction is a semi join; absent tables are left out.
    """
    ids = lambda df, c, name: df.select(F.col(c).alias(name)).where(F.col(name).isNotNull()).distinct()
    chosen = tables["settlement"].join(ids(settlements, "id", "id"), "id", "left_semi")
    out = {"settlement": chosen}
    counties = ids(chosen, "county_id", "county_id")
    within = {"county": ("id", counties, "county_id"), "national_individual_electoral_district": ("county_id", counties, "county_id")}
    if "address" in tables:
        out["address"] = tables["address"].join(ids(chosen, "id", "settlement_id"), "settlement_id", "left_semi").select(*tables["address"].columns)
        within["postal_code"] = ("id", ids(out["address"], "postal_code_id", "postal_code_id"), "postal_code_id")
        if "address_mapping" in tables:
            originals = ids(out["address"], "id", "original_address_id")
            kept = tables["address_mapping"].join(originals, "original_address_id", "left_semi")
            within["address_mapping"] = ("original_address_id", originals, "original_address_id")
            groups = ids(kept, "canonical_address_id", "canonical_address_id")
            within |= {"canonical_address": ("id", groups, "canonical_address_id"), "address_polling_stations": ("canonical_address_id", groups, "canonical_address_id"), "address_pir_codes": ("canonical_address_id", groups, "canonical_address_id")}
    for name in ("settlement_individual_electoral_district", "polling_station", "postal_code_settlement", "settlement_public_spaces"):
        within[name] = ("settlement_id", ids(chosen, "id", "settlement_id"), "settlement_id")
    for name, (column, keep, key) in within.items():
        if name in tables:
            keep = keep.withColumnRenamed(key, "__keep")
            out[name] = tables[name].join(keep, F.col(column) == F.col("__keep"), "left_semi")
    return out


def chosen_settlements(settlements: DataFrame, counties: DataFrame, capital: str, of_capital: int = 3, of_others: int = 10, n_counties: int = 3) -> DataFrame:
    """The first settlements by code of the capital's county and of the first other counties by code: column ``id``."""
    from pyspark.sql import Window

    ranked = counties.select(F.col("id").alias("county_id"), "county_code", (F.col("county_name") == capital).alias("is_capital")).distinct()
    others = ranked.where("NOT is_capital").orderBy("county_code", "county_id").limit(n_counties)  # the limit is the feature
    some = ranked.where("is_capital").unionByName(others)
    own = settlements.select("id", "county_id", "settlement_code").distinct().join(some, "county_id")
    place = F.row_number().over(Window.partitionBy("county_id").orderBy("settlement_code", "id"))
    return own.withColumn("n", place).where(F.col("n") <= F.when(F.col("is_capital"), of_capital).otherwise(of_others)).select("id").distinct()
