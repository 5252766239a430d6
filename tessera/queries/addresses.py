"""Queries on address text, entities and entity resolution, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import textops as X
from tessera.functions.keys import cache_key, md5_16, pseudo_uuid3, uuid3, uuid5
from tessera.operators.dedup import dedup_report, survivors_by_score, with_canonical_id
from tessera.operators.public_spaces import public_spaces
from tessera.operators.tables import distinct_list, first_by, keep_first, last_wins, merge_columns, messages, parents, with_sequence
from tessera.plans.pipeline import entities
from tessera.session import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[name or f.__name__] = f
        if sql is not None:
            ORACLE[name or f.__name__] = sql
        return f

    return add


def staging(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "staging_korzet")


# SQL fragments: the same definitions as the column expressions, written for DuckDB.
def t(c: str) -> str:
    return f"trim(coalesce({c}, ''))"


def id16(*cs: str) -> str:
    return f"substr(md5(concat_ws('|', {', '.join(f"coalesce({c}, '')" for c in cs)})), 1, 16)"


def nozero(c: str, empty: str = "0") -> str:
    return f"CASE WHEN ltrim({c}, '0') = '' THEN '{empty}' ELSE ltrim({c}, '0') END"


def keep_digit(c: str) -> str:
    return f"regexp_replace({c}, '^0+([0-9])', '\\1')"


def clean_house(c: str) -> str:
    x, base = t(c), f"split_part({t(c)}, '/', 1)"
    return f"""CASE WHEN {x} = '' THEN '' WHEN len(list_filter(string_split({base}, '-'), lambda p: ltrim(p, '0') = '' AND length(p) > 0)) > 0 THEN ''
        ELSE array_to_string(list_transform(string_split({base}, '-'), lambda p: ltrim(p, '0')), '-') || substr({x}, length({base}) + 1) END"""


def clean_unit(c: str) -> str:
    return f"CASE WHEN regexp_full_match({t(c)}, '[0-9]+') THEN ltrim({t(c)}, '0') ELSE upper({t(c)}) END"


def roman(c: str) -> str:
    n = f"try_cast({c} AS INTEGER)"
    ones = "['', 'I', 'II', 'III', 'IV', 'V', 'VI', 'VII', 'VIII', 'IX']"
    tens = "['', 'X', 'XX', 'XXX', 'XL', 'L', 'LX', 'LXX', 'LXXX', 'XC']"
    hundreds = "['', 'C', 'CC', 'CCC', 'CD', 'D', 'DC', 'DCC', 'DCCC', 'CM']"
    return f"""CASE WHEN regexp_full_match({c}, '[0-9]+') AND {n} BETWEEN 1 AND 3999 THEN repeat('M', {n} // 1000) || {hundreds}[({n} // 100) % 10 + 1] || {tens}[({n} // 10) % 10 + 1] || {ones}[{n} % 10 + 1] ELSE {c} END"""


_UNITS = lambda rel: f"""SELECT *, {clean_house("house_number")} AS h, {t("house_number")} AS raw,
    CASE WHEN regexp_full_match({t("building")}, '[0-9]+') THEN {nozero(t("building"))} ELSE upper({t("building")}) END AS b,
    CASE WHEN regexp_full_match({t("staircase")}, '[0-9]+') THEN {nozero(t("staircase"))} ELSE upper({t("staircase")}) END AS s0,
    regexp_full_match({t("building")}, '[0-9]+') AND regexp_full_match({t("staircase")}, '[0-9]+') AS numeric_units,
    trim(coalesce(street_name, '') || ' ' || coalesce(street_type, '')) AS p FROM {rel}"""  # noqa: E731


def formatted(rel: str, columns: str) -> str:
    """SELECT of columns with ``full_address`` by the decision table, from a relation with the five parts."""
    return f"""SELECT {columns}, CASE
      WHEN h = '' AND b <> '' AND s <> '' THEN p || ', ' || b || '. épület ' || s || '. lépcsőház'
      WHEN h = '' AND b <> '' THEN p || ', ' || b || '. épület'
      WHEN h = '' AND s <> '' THEN p || ', ' || s || '. lépcsőház'
      WHEN h = '' THEN p
      WHEN raw LIKE '%/%' AND b <> '' AND s <> '' THEN p || ' ' || split_part(h, '/', 1) || '. ' || b || '. épület ' || s || '. lépcsőház'
      WHEN raw LIKE '%/%' AND s <> '' THEN p || ' ' || h || '. ' || s || '. lépcsőház'
      WHEN raw LIKE '%/%' THEN p || ' ' || h || '.'
      WHEN b <> '' AND s <> '' AND (raw LIKE '%-%' OR numeric_units) THEN p || ' ' || h || '. ' || b || '. épület ' || s || '. lépcsőház'
      WHEN b <> '' AND s <> '' THEN p || ' ' || h || '/' || b || '. ' || s || '. lépcsőház'
      WHEN b <> '' THEN p || ' ' || h || '/' || b || '.'
      WHEN s <> '' THEN p || ' ' || h || '/' || s || '.'
      ELSE p || ' ' || h || '.' END AS full_address
    FROM (SELECT *, CASE WHEN regexp_full_match({t("staircase")}, '[0-9]+') THEN {roman("s0")} ELSE s0 END AS s FROM ({_UNITS(rel)}))"""


_CLEANED = f"""(SELECT row_id, county_code, settlement_name, street_name, street_type, {clean_house("house_number")} AS house_number, {clean_unit("building")} AS building, {clean_unit("staircase")} AS staircase, accessible, polling_station_code, postal_code FROM staging_korzet)"""
_NORMAL = lambda c: f"upper(regexp_replace({t(c)}, '\\s+', ' ', 'g'))"
_KEYED = f"""SELECT *, substr(md5(upper({t("county_code")}) || '|' || {_NORMAL("settlement_name")} || '|' || {_NORMAL("full_address")}), 1, 16) AS canonical_address_id
    FROM ({formatted(_CLEANED, "row_id, county_code, settlement_name, street_name, street_type, house_number, building, staircase, accessible, polling_station_code, postal_code")})"""
_SCORE = """CASE WHEN house_number LIKE '%/%' THEN 50 + CASE WHEN building <> '' THEN 5 ELSE 0 END ELSE 100 + CASE WHEN building <> '' THEN 10 ELSE 0 END END + CASE WHEN staircase <> '' THEN 10 ELSE 0 END"""


@query(f"SELECT trim(county_code) AS county_code, trim(settlement_code) AS settlement_code, max(trim(settlement_name)) AS settlement_name, {id16('trim(county_code)')} AS county_id, {id16('trim(county_code)', 'trim(settlement_code)')} AS settlement_id FROM staging_korzet WHERE trim(settlement_code) <> '' GROUP BY 1, 2, 4, 5")
def entity_hierarchy_keys(spark, sf):
    s = entities({"staging": staging(spark, sf)})["settlement"]
    return s.select("county_code", "settlement_code", "settlement_name", md5_16("county_code").alias("county_id"), F.col("id").alias("settlement_id"))


@query(f"SELECT trim(county_code) AS county_code, max(trim(county_name)) AS county_name, {id16('trim(county_code)')} AS id FROM staging_korzet WHERE trim(county_code) <> '' GROUP BY 1")
def dim_distinct_label_max(spark, sf):
    return entities({"staging": staging(spark, sf)})["county"]


@query("SELECT c.id, c.county_code, d.id AS district_id FROM (SELECT DISTINCT id, county_code FROM county) c LEFT JOIN national_individual_electoral_district d ON lower(trim(d.county_id)) = c.id AND d.oevk = '01'")
def dim_left_join_on_filter(spark, sf):
    d = table(spark, sf, "national_individual_electoral_district").where("oevk = '01'").select(F.col("id").alias("district_id"), F.lower(F.trim("county_id")).alias("id"))
    return table(spark, sf, "county").select("id", "county_code").distinct().join(d, "id", "left")


_TEVK = "nullif(trim(tevk_code), '')"
@query(f"SELECT DISTINCT trim(county_code) AS county_code, trim(settlement_code) AS settlement_code, coalesce({_TEVK}, '-') AS tevk, CASE WHEN {_TEVK} IS NULL THEN trim(settlement_name) ELSE trim(settlement_name) || ' ' || {_TEVK} || '. TEVK' END AS district_name, {id16('trim(county_code)', 'trim(settlement_code)', f"coalesce({_TEVK}, '-')")} AS id FROM staging_korzet")
def null_safe_district_name(spark, sf):
    tevk = F.nullif(F.trim("tevk_code"), F.lit(""))
    c, s, n = F.trim("county_code"), F.trim("settlement_code"), F.trim("settlement_name")
    return staging(spark, sf).select(
        c.alias("county_code"), s.alias("settlement_code"), F.coalesce(tevk, F.lit("-")).alias("tevk"),
        F.when(tevk.isNull(), n).otherwise(F.concat(n, F.lit(" "), tevk, F.lit(". TEVK"))).alias("district_name"), md5_16(c, s, F.coalesce(tevk, F.lit("-"))).alias("id")).distinct()


@query(f"SELECT DISTINCT {id16('trim(postal_code)')} AS postal_code_id, {id16('trim(county_code)', 'trim(settlement_code)')} AS settlement_id, {id16(id16('trim(postal_code)'), id16('trim(county_code)', 'trim(settlement_code)'))} AS id FROM staging_korzet WHERE trim(postal_code) NOT IN ('', '0')")
def junction_distinct(spark, sf):
    s = staging(spark, sf).where(~F.trim("postal_code").isin("", "0"))
    p = s.select(md5_16(F.trim("postal_code")).alias("postal_code_id"), md5_16(F.trim("county_code"), F.trim("settlement_code")).alias("settlement_id")).distinct()
    return p.withColumn("id", md5_16("postal_code_id", "settlement_id"))


@query("SELECT trim(county_code) AS county_code, trim(settlement_code) AS settlement_code, trim(polling_station_address) AS address, min(trim(polling_station_code)) AS any_code, count(*) AS n FROM staging_korzet WHERE trim(polling_station_address) <> '' GROUP BY 1, 2, 3")
def station_any_value(spark, sf):
    s = staging(spark, sf).select(*(F.trim(c).alias(c) for c in ("county_code", "settlement_code", "polling_station_address", "polling_station_code")))
    return s.where("polling_station_address != ''").groupBy("county_code", "settlement_code", F.col("polling_station_address").alias("address")).agg(F.min("polling_station_code").alias("any_code"), F.count(F.lit(1)).alias("n"))


@query("SELECT row_id, row_number() OVER (ORDER BY run_tag, row_id) AS original_order, (row_number() OVER (ORDER BY run_tag, row_id) - 1) % 1000 + 1 AS sequence FROM staging_korzet")
def fact_sequence(spark, sf):
    s = with_sequence(staging(spark, sf).select("run_tag", "row_id"), ["run_tag", "row_id"], "original_order")
    return s.select("row_id", "original_order", ((F.col("original_order") - 1) % 1000 + 1).alias("sequence"))


def _versions(spark, sf):
    a = table(spark, sf, "address_mapping").select("original_address_id", "canonical_address_id", "created_at", "id")
    split = F.col("created_at") < F.lit("2025-10-20").cast("timestamp_ntz")
    return a.where(split), a.where(~split)


_OLD, _NEW = "address_mapping WHERE created_at < '2025-10-20'", "address_mapping WHERE created_at >= '2025-10-20'"
_COLS = "original_address_id, canonical_address_id, created_at, id"


@query(f"SELECT {_COLS} FROM {_OLD} UNION ALL SELECT {_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY original_address_id ORDER BY created_at, id) AS n FROM {_NEW} AND original_address_id NOT IN (SELECT original_address_id FROM {_OLD} AND original_address_id IS NOT NULL)) WHERE n = 1")
def upsert_keep_first(spark, sf):
    old, new = _versions(spark, sf)
    return keep_first(old, new, ["original_address_id"], [F.col("created_at"), F.col("id")])


@query(f"SELECT {_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY original_address_id ORDER BY created_at DESC, id DESC) AS n FROM address_mapping) WHERE n = 1")
def upsert_last_wins(spark, sf):
    old, new = _versions(spark, sf)
    return last_wins(old, new, ["original_address_id"], ["created_at", "id"]).select(*old.columns)


@query("SELECT coalesce(c.id, g.id) AS id, coalesce(g.latitude, c.latitude) AS latitude, coalesce(g.longitude, c.longitude) AS longitude FROM (SELECT id, max(latitude) AS latitude, max(longitude) AS longitude FROM canonical_address GROUP BY 1) c FULL JOIN (SELECT canonical_address_id AS id, max(latitude) AS latitude, max(longitude) AS longitude FROM geocoding_cache WHERE quality <> 'failed' GROUP BY 1) g ON c.id = g.id")
def upsert_partial_columns(spark, sf):
    point = [F.max("latitude").alias("latitude"), F.max("longitude").alias("longitude")]
    new = table(spark, sf, "geocoding_cache").where("quality != 'failed'").groupBy(F.col("canonical_address_id").alias("id")).agg(*point)
    return merge_columns(table(spark, sf, "canonical_address").groupBy("id").agg(*point), new, ["id"], ["latitude", "longitude"])


_V1 = f"""CASE WHEN coalesce(x, '') = '' THEN '' WHEN x LIKE '%-%' THEN ({nozero("split_part(x, '-', 1)")}) || '-' || ({nozero("substr(x, instr(x, '-') + 1)")})
  WHEN x LIKE '%/%' THEN CASE WHEN regexp_matches(x, '^[0-9]+/') THEN {keep_digit("split_part(x, '/', 1)")} || substr(x, instr(x, '/')) ELSE x END
  WHEN regexp_full_match(x, '[0-9]+') THEN {nozero("x")} ELSE x END"""
_V3 = f"""CASE WHEN {t("x")} IN ('', 'NULL') THEN '' ELSE array_to_string(list_transform(string_split({t("x")}, '-'), lambda p: CASE WHEN regexp_matches(p, '^0*[0-9]+') THEN {keep_digit("p")} ELSE p END), '-') END"""


@query(f"SELECT x AS house_number, {_V1} AS trimmed, {_V3} AS for_export, {clean_house('x')} AS cleaned, CASE WHEN regexp_full_match(coalesce(x, ''), '0+') THEN '' ELSE coalesce(x, '') END AS not_zero, CASE WHEN regexp_matches(coalesce(x, ''), '^0+[1-9]') THEN ltrim(x, '0') ELSE coalesce(x, '') END AS by_pattern FROM (SELECT DISTINCT house_number AS x FROM staging_korzet)")
def trim_zero_variants(spark, sf):
    h = staging(spark, sf).select("house_number").distinct()
    return h.select("house_number", X.trim_zeros("house_number").alias("trimmed"), X.trim_zeros_export("house_number").alias("for_export"), X.clean_house_number("house_number").alias("cleaned"), X.zero_only_to_empty("house_number").alias("not_zero"), X.strip_leading_zeros_regex("house_number").alias("by_pattern"))


@query(f"SELECT DISTINCT building, staircase, {clean_unit('building')} AS clean_building, {clean_unit('staircase')} AS clean_staircase FROM staging_korzet")
def clean_units(spark, sf):
    return staging(spark, sf).select("building", "staircase", X.clean_unit("building").alias("clean_building"), X.clean_unit("staircase").alias("clean_staircase")).distinct()


@query(f"SELECT n, {roman('n')} AS numeral FROM (SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS n FROM part UNION SELECT DISTINCT coalesce(staircase, '') FROM staging_korzet)")
def roman_numerals(spark, sf):
    n = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("n")).unionByName(staging(spark, sf).select(F.coalesce("staircase", F.lit("")).alias("n"))).distinct()
    return n.select("n", X.roman("n").alias("numeral"))


@query(formatted("(SELECT DISTINCT street_name, street_type, house_number, building, staircase FROM staging_korzet)", "street_name, street_type, house_number, building, staircase"))
def full_address_format(spark, sf):
    parts = ["street_name", "street_type", "house_number", "building", "staircase"]
    d = staging(spark, sf).select(*parts).distinct()
    return X.with_full_address(d, *parts)


@query("SELECT DISTINCT street_name, street_type, house_number, trim(concat_ws(' ', street_name, street_type, house_number, coalesce(building, ''), coalesce(staircase, ''))) AS plain, CASE WHEN street_name IS NOT NULL AND house_number IS NOT NULL THEN trim(regexp_replace(concat_ws(' ', street_name, street_type, house_number, building, staircase), '\\s+', ' ', 'g')) END AS collapsed, concat_ws(' ', nullif(street_name, ''), nullif(street_type, ''), nullif(house_number, ''), nullif(building, ''), nullif(staircase, '')) AS joined FROM staging_korzet")
def full_address_variants(spark, sf):
    b, s = F.coalesce("building", F.lit("")), F.coalesce("staircase", F.lit(""))
    c = [F.col(x) for x in ("street_type", "house_number", "building", "staircase")]
    return staging(spark, sf).select("street_name", "street_type", "house_number", X.plain_address(F.col("street_name"), F.col("street_type"), F.col("house_number"), b, s).alias("plain"), X.collapsed_address(F.col("street_name"), *c).alias("collapsed"), X.joined_address(F.col("street_name"), *c).alias("joined")).distinct()


@query(f"SELECT house_number, building, staircase, CAST({_SCORE} AS INTEGER) AS score, CAST(CASE WHEN house_number NOT LIKE '%/%' AND building NOT IN ('', '0') THEN 100 WHEN house_number NOT LIKE '%/%' AND staircase NOT IN ('', '0') THEN 90 ELSE 50 END AS INTEGER) AS for_export FROM (SELECT DISTINCT {t('house_number')} AS house_number, {t('building')} AS building, {t('staircase')} AS staircase FROM staging_korzet)")
def structure_score(spark, sf):
    c = ["house_number", "building", "staircase"]
    d = staging(spark, sf).select(*(F.trim(F.coalesce(x, F.lit(""))).alias(x) for x in c)).distinct()
    return d.select(*c, X.structure_score(*c).alias("score"), X.export_score(*c).alias("for_export"))


def _keyed(spark, sf):
    return with_canonical_id(staging(spark, sf))


@query(f"""SELECT canonical_address_id, county_code, settlement_name, street_name, house_number AS house, building AS bldg, staircase AS stairs, full_address, flag AS accessibility_flag FROM (
  SELECT *, row_number() OVER (PARTITION BY canonical_address_id ORDER BY {_SCORE} DESC, row_id) AS n, max(CASE WHEN trim(accessible) = 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY canonical_address_id) AS flag FROM ({_KEYED})) WHERE n = 1""")
def canonical_dedup(spark, sf):
    return survivors_by_score(_keyed(spark, sf))


@query(f"SELECT DISTINCT canonical_address_id, trim(polling_station_code) AS polling_station_code FROM ({_KEYED}) WHERE polling_station_code IS NOT NULL")
def relationship_preservation(spark, sf):
    return _keyed(spark, sf).where("polling_station_code IS NOT NULL").select("canonical_address_id", F.trim("polling_station_code").alias("polling_station_code")).distinct()


@query(f"SELECT DISTINCT canonical_address_id, trim(postal_code) AS postal_code FROM ({_KEYED}) WHERE trim(postal_code) <> ''")
def relationship_postal_codes(spark, sf):
    return _keyed(spark, sf).select("canonical_address_id", F.trim("postal_code").alias("postal_code")).where("postal_code != ''").distinct()


@query(f"SELECT row_id, canonical_address_id FROM ({_KEYED})")
def address_mapping_total(spark, sf):
    return _keyed(spark, sf).select("row_id", "canonical_address_id")


@query(f"SELECT count(*) AS total_addresses, count(DISTINCT canonical_address_id) AS canonical_addresses, count(*) - count(DISTINCT canonical_address_id) AS duplicates, round((count(*) - count(DISTINCT canonical_address_id)) / count(*), 6) AS duplicate_rate FROM ({_KEYED})", name="dedup_report")
def _dedup_report(spark, sf):
    return dedup_report(_keyed(spark, sf))


@query("SELECT id, count(*) AS n FROM canonical_address GROUP BY 1 HAVING count(*) > 1")
def duplicate_key_check(spark, sf):
    return table(spark, sf, "canonical_address").groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def _spaces(spark, sf):
    s = staging(spark, sf).withColumn("settlement_id", md5_16(F.trim("county_code"), F.trim("settlement_code")))
    return public_spaces(s, "settlement_id", "street_name", "street_type")


@query(f"SELECT DISTINCT {id16('trim(street_name)')} AS id, trim(street_name) AS name FROM staging_korzet WHERE trim(street_name) <> ''")
def public_space_names(spark, sf):
    return _spaces(spark, sf)["names"]


@query(f"SELECT DISTINCT {id16('trim(street_type)')} AS id, trim(street_type) AS name FROM staging_korzet WHERE trim(street_type) <> ''")
def public_space_types(spark, sf):
    return _spaces(spark, sf)["types"]


_SID = id16("trim(county_code)", "trim(settlement_code)")
@query(f"SELECT *, {id16('settlement_id', 'name_id', 'type_id')} AS id FROM (SELECT DISTINCT {_SID} AS settlement_id, {id16('trim(street_name)')} AS name_id, {id16('trim(street_type)')} AS type_id FROM staging_korzet WHERE trim(street_name) <> '' AND trim(street_type) <> '')")
def public_space_junction(spark, sf):
    return _spaces(spark, sf)["junction"]


@query(f"SELECT row_id, CASE WHEN trim(street_name) <> '' THEN {id16('trim(street_name)')} END AS name_id, CASE WHEN trim(street_type) <> '' THEN {id16('trim(street_type)')} END AS type_id, trim(concat_ws(' ', street_name, street_type, CASE WHEN regexp_matches(coalesce(house_number, ''), '^0+[1-9]') THEN ltrim(house_number, '0') ELSE coalesce(house_number, '') END)) AS formatted FROM staging_korzet")
def public_space_attach(spark, sf):
    a = _spaces(spark, sf)["addresses"]
    return a.select("row_id", "name_id", "type_id", X.plain_address(F.col("street_name"), F.col("street_type"), X.strip_leading_zeros_regex("house_number")).alias("formatted"))


@query("SELECT (SELECT count(DISTINCT trim(street_name)) FROM staging_korzet WHERE trim(street_name) <> '') AS names, (SELECT count(DISTINCT trim(street_type)) FROM staging_korzet WHERE trim(street_type) <> '') AS types, count(*) AS addresses, count(CASE WHEN trim(street_name) <> '' THEN 1 END) AS linked FROM staging_korzet")
def public_space_metrics(spark, sf):
    a = _spaces(spark, sf)["addresses"]
    return a.agg(F.count_distinct("name_id").alias("names"), F.count_distinct("type_id").alias("types"), F.count(F.lit(1)).alias("addresses"), F.count("name_id").alias("linked"))


def _uuid_sql(version: int) -> str:
    from tessera.functions.keys import NAMESPACE

    d = ("md5" if version == 3 else "sha1") + f"(unhex('{NAMESPACE.hex}') || encode(id))"
    v = f"['8','9','a','b','8','9','a','b','8','9','a','b','8','9','a','b'][instr('0123456789abcdef', substr({d}, 17, 1))]"
    return f"substr({d}, 1, 8) || '-' || substr({d}, 9, 4) || '-{version}' || substr({d}, 14, 3) || '-' || {v} || substr({d}, 18, 3) || '-' || substr({d}, 21, 12)"


def _pseudo_sql() -> str:
    from tessera.functions.keys import NAMESPACE

    d = f"md5('{NAMESPACE}' || id)"
    return f"substr({d}, 1, 8) || '-' || substr({d}, 9, 4) || '-3' || substr({d}, 14, 3) || '-' || substr({d}, 17, 4) || '-' || substr({d}, 21, 12)"


@query(f"SELECT DISTINCT id, {_uuid_sql(3)} AS uuid3, {_uuid_sql(5)} AS uuid5, {_pseudo_sql()} AS pseudo, sha256(id) AS sha256, md5(coalesce(settlement_name, '') || '|' || coalesce(street_name, '') || '|' || coalesce(house_number, '')) AS cache_key FROM canonical_address")
def uuid_v3_v5(spark, sf):
    return table(spark, sf, "canonical_address").select("id", uuid3("id").alias("uuid3"), uuid5("id").alias("uuid5"), pseudo_uuid3("id").alias("pseudo"), F.sha2("id", 256).alias("sha256"), cache_key("settlement_name", "street_name", "house_number").alias("cache_key")).distinct()


_ST = "lower(coalesce(polling_station_address, ''))"
_PAT = X.STATION_STREET.replace("'", "''")
@query(f"SELECT DISTINCT polling_station_address, trim(regexp_replace(coalesce(polling_station_address, ''), '\\s*\\([^)]*\\)\\s*', ' ', 'g')) AS bare, CASE WHEN trim(regexp_extract({_ST}, '{_PAT}', 1)) <> '' THEN trim(regexp_extract({_ST}, '{_PAT}', 1)) || ' ' || regexp_extract({_ST}, '{_PAT}', 2) END AS street FROM polling_station")
def component_extraction(spark, sf):
    return table(spark, sf, "polling_station").select("polling_station_address", X.without_parentheses("polling_station_address").alias("bare"), X.station_street("polling_station_address").alias("street")).distinct()


@query(f"SELECT DISTINCT house_number, try_cast(regexp_extract({t('house_number')}, '^([0-9]+)', 1) AS INTEGER) AS number FROM staging_korzet")
def house_number_int(spark, sf):
    return staging(spark, sf).select("house_number", X.house_int("house_number").alias("number")).distinct()


_LABEL = "concat_ws('/', settlement_name, street_name || chr(39) || 's\\House', house_number, 'pirCode', 'HTMLPage')"
@query(f"SELECT DISTINCT x, regexp_replace(regexp_replace(x, '/', '_', 'g'), '\\\\', '_', 'g') AS file, chr(39) || replace(x, chr(39), chr(39) || chr(39)) || chr(39) AS literal, lower(regexp_replace(regexp_replace(x, '([a-z0-9])([A-Z])', '\\1_\\2', 'g'), '([A-Z]+)([A-Z][a-z])', '\\1_\\2', 'g')) AS snake, upper(regexp_replace(trim(x), '\\s+', ' ', 'g')) AS normal FROM (SELECT {_LABEL} AS x FROM staging_korzet)")
def text_helpers(spark, sf):
    """On texts with capitals, both slashes, quotes and blanks."""
    x = F.concat_ws("/", F.col("settlement_name"), F.concat("street_name", F.lit("'s\\House")), F.col("house_number"), F.lit("pirCode"), F.lit("HTMLPage")).alias("x")
    return staging(spark, sf).select(x).distinct().select("x", X.file_name("x").alias("file"), X.sql_literal("x").alias("literal"), X.snake_case("x").alias("snake"), X.normal_text("x").alias("normal"))


def _rule(c: str, pattern: str) -> Column:
    return F.trim(c).rlike(f"^{pattern}$")


@query(r"""SELECT row_id, concat_ws('; ', CASE WHEN NOT coalesce(regexp_full_match(trim(county_code), '[0-9]{2}'), false) THEN 'county_code must have two digits' END,
  CASE WHEN NOT coalesce(regexp_full_match(trim(settlement_code), '[0-9]+'), false) THEN 'settlement_code must be digits' END,
  CASE WHEN NOT coalesce(regexp_full_match(trim(postal_code), '[0-9]{4}'), false) THEN 'postal_code must have four digits' END,
  CASE WHEN NOT coalesce(trim(street_name) <> '', false) THEN 'street_name is missing' END,
  CASE WHEN NOT coalesce(trim(gate_code) <> '', false) THEN 'gate_code is missing' END,
  CASE WHEN NOT coalesce(regexp_full_match(trim(tevk_code), '[0-9]{2}'), false) THEN 'tevk_code must have two digits' END) AS problems FROM staging_korzet""")
def validation_rules(spark, sf):
    rules = {
        "county_code must have two digits": _rule("county_code", "[0-9]{2}"), "settlement_code must be digits": _rule("settlement_code", "[0-9]+"),
        "postal_code must have four digits": _rule("postal_code", "[0-9]{4}"), "street_name is missing": F.trim("street_name") != "",
        "gate_code is missing": F.trim("gate_code") != "", "tevk_code must have two digits": _rule("tevk_code", "[0-9]{2}"),
    }
    return staging(spark, sf).select("row_id", messages(rules).alias("problems"))


@query(r"""SELECT row_id FROM staging_korzet WHERE len(list_filter(string_split(split_part(trim(coalesce(house_number, '')), '/', 1), '-'), lambda p: ltrim(p, '0') = '')) > 0""")
def all_zero_house_numbers(spark, sf):
    base = F.substring_index(F.trim(F.coalesce("house_number", F.lit(""))), "/", 1)
    return staging(spark, sf).where(F.exists(F.split(base, "-"), lambda p: F.regexp_replace(p, "^0+", "") == "")).select("row_id")


@query("SELECT trim(county_code) AS county_code, trim(settlement_code) AS settlement_code, string_agg(DISTINCT trim(tevk_code), ',' ORDER BY trim(tevk_code)) AS tevk_list, count(DISTINCT trim(oevk_code)) AS n_oevk FROM (SELECT county_code, settlement_code, oevk_code, nullif(trim(tevk_code), '') AS tevk_code FROM staging_korzet) GROUP BY 1, 2")
def list_aggregation(spark, sf):
    tevk = F.nullif(F.trim("tevk_code"), F.lit(""))
    return staging(spark, sf).groupBy(F.trim("county_code").alias("county_code"), F.trim("settlement_code").alias("settlement_code")).agg(distinct_list(tevk).alias("tevk_list"), F.count_distinct(F.trim("oevk_code")).alias("n_oevk"))


_PARENTS = lambda kind, child, parent: f"SELECT '{kind}' AS kind, {child} AS child, count(DISTINCT {parent}) AS n_parents FROM staging_korzet WHERE {child} <> '' GROUP BY 2 HAVING count(DISTINCT {parent}) > 1"
_DISTRICT = "trim(county_code) || '|' || trim(settlement_code) || '|' || nullif(trim(tevk_code), '')"
_TOWN = "trim(county_code) || '|' || trim(settlement_code)"
@query(" UNION ALL ".join([_PARENTS("district", _DISTRICT, "trim(oevk_code)"), _PARENTS("postal_code", "trim(postal_code)", _TOWN), _PARENTS("settlement", _TOWN, "nullif(trim(tevk_code), '')")]))
def multi_parent(spark, sf):
    """Districts, postal codes and settlements that belong to several of what they should, or may, belong to one of."""
    town = F.concat(F.trim("county_code"), F.lit("|"), F.trim("settlement_code"))
    tevk = F.nullif(F.trim("tevk_code"), F.lit(""))
    one = lambda kind, child, parent: parents(staging(spark, sf).select(child.alias("child"), parent.alias("parent")).where("child != ''"), "child", "parent").select(F.lit(kind).alias("kind"), "child", "n_parents")
    return one("district", F.concat(town, F.lit("|"), tevk), F.trim("oevk_code")).unionByName(one("postal_code", F.trim("postal_code"), town)).unionByName(one("settlement", town, tevk))


@query("SELECT gate_code, row_id, street_name FROM (SELECT trim(gate_code) AS gate_code, row_id, street_name, row_number() OVER (PARTITION BY trim(gate_code) ORDER BY run_tag DESC, loaded_at DESC, row_id) AS n FROM staging_korzet WHERE trim(gate_code) <> '') WHERE n = 1")
def first_value_pick(spark, sf):
    s = staging(spark, sf).where("trim(gate_code) != ''").select(F.trim("gate_code").alias("gate_code"), "row_id", "street_name", "run_tag", "loaded_at")
    return first_by(s, ["gate_code"], [F.desc("run_tag"), F.desc("loaded_at"), F.asc("row_id")]).select("gate_code", "row_id", "street_name")


@query("SELECT trim(street_type) AS street_type, count(*) AS n FROM staging_korzet WHERE street_type IS NOT NULL GROUP BY 1")
def frequency_profile(spark, sf):
    return staging(spark, sf).where("street_type IS NOT NULL").groupBy(F.trim("street_type").alias("street_type")).agg(F.count(F.lit(1)).alias("n"))
