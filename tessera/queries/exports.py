"""Queries on tables to be exported, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import textops as X
from tessera.functions.keys import NAMESPACE, md5_16
from tessera.operators.dedup import survivors_by_score, with_canonical_id
from tessera.operators.export import EXPORTED, NIL, address_facts, as_exported, canonical_served, canonical_wide, chosen_settlements, closed_subset
from tessera.queries.addresses import _KEYED, ORACLE as _OTHER, id16, keep_digit, t
from tessera.session import cut, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
CAPITAL = "Élesd-föld"  # the county whose settlements the subset takes as the capital's districts


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        QUERIES[name or f.__name__] = f
        if sql is not None:
            ORACLE[name or f.__name__] = sql
        return f

    return add


def uuid_of(c: str, version: int) -> str:
    d = ("md5" if version == 3 else "sha1") + f"(unhex('{NAMESPACE.hex}') || encode({c}))"
    v = f"['8','9','a','b','8','9','a','b','8','9','a','b','8','9','a','b'][instr('0123456789abcdef', substr({d}, 17, 1))]"
    return f"CASE WHEN {c} <> '' THEN substr({d}, 1, 8) || '-' || substr({d}, 9, 4) || '-{version}' || substr({d}, 14, 3) || '-' || {v} || substr({d}, 18, 3) || '-' || substr({d}, 21, 12) END"


def for_export(c: str) -> str:
    return f"CASE WHEN {t(c)} IN ('', 'NULL') THEN '' ELSE array_to_string(list_transform(string_split({t(c)}, '-'), lambda p: CASE WHEN regexp_matches(p, '^0*[0-9]+') THEN {keep_digit('p')} ELSE p END), '-') END"


def no_zeros(c: str) -> str:
    return f"CASE WHEN {c} IN ('', 'NULL') OR regexp_full_match(trim({c}), '0+') THEN '' ELSE {c} END"


_given = lambda c, key: f"CASE WHEN {t(c)} <> '' THEN {key} END"
_TEVK = f"coalesce(nullif({t('tevk_code')}, ''), '-')"
_FACTS = f"""SELECT CAST(row_id AS VARCHAR) AS id, row_number() OVER (ORDER BY run_tag, row_id) AS original_order, {t('street_name')} AS space_name, {t('street_type')} AS space_type, {t('house_number')} AS house_number, {t('building')} AS building, {t('staircase')} AS staircase,
  {_given('county_code', id16(t('county_code')))} AS county_id, {_given('settlement_code', id16(t('county_code'), t('settlement_code')))} AS settlement_id, {_given('street_name', id16(t('street_name')))} AS space_name_id, {_given('street_type', id16(t('street_type')))} AS space_type_id,
  {_given('oevk_code', id16(t('county_code'), t('oevk_code')))} AS oevk_id, {_given('settlement_code', id16(t('county_code'), t('settlement_code'), _TEVK))} AS tevk_id, CASE WHEN {t('postal_code')} NOT IN ('', '0') THEN {t('postal_code')} END AS postal_code, CASE WHEN {t('postal_code')} NOT IN ('', '0') THEN {id16(t('postal_code'))} END AS postal_code_id,
  {_given('polling_station_address', id16(t('county_code'), t('settlement_code'), t('oevk_code'), _TEVK, t('polling_station_address')))} AS polling_station_id FROM staging_korzet"""
_MADE = f"""WITH facts AS MATERIALIZED ({_FACTS}),
mapping AS MATERIALIZED (SELECT CAST(row_id AS VARCHAR) AS id, canonical_address_id AS c FROM ({_KEYED})),
canonical AS MATERIALIZED (SELECT canonical_address_id, trim(county_code) AS county_code, trim(settlement_name) AS settlement_name, street_name, house, bldg, stairs, full_address FROM ({_OTHER['canonical_dedup']})),
county AS (SELECT DISTINCT trim(county_code) AS county_code, {id16('trim(county_code)')} AS id, max(trim(county_name)) OVER (PARTITION BY trim(county_code)) AS county_name FROM staging_korzet WHERE trim(county_code) <> ''),
settlement AS (SELECT trim(county_code) AS county_code, trim(settlement_code) AS settlement_code, max(trim(settlement_name)) AS settlement_name, {id16('trim(county_code)')} AS county_id, {id16('trim(county_code)', 'trim(settlement_code)')} AS id FROM staging_korzet WHERE trim(settlement_code) <> '' GROUP BY 1, 2, 4, 5)"""


def made(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The tables that the exports are made of, from the staging table; what several of them need is written down once."""
    staging = table(spark, sf, "staging_korzet")
    keyed = cut(with_canonical_id(staging).select("row_id", "canonical_address_id", "county_code", "settlement_name", "street_name", "house", "bldg", "stairs", "full_address", "accessible"))
    addresses = address_facts(staging)
    mapping = keyed.select(F.col("row_id").cast("string").alias("original_address_id"), "canonical_address_id")
    s = staging.select(*(F.trim(c).alias(c) for c in ("county_code", "county_name", "settlement_code", "settlement_name")))
    county = s.where("county_code != ''").groupBy("county_code").agg(F.max("county_name").alias("county_name")).withColumn("id", md5_16("county_code"))
    settlement = s.where("settlement_code != ''").groupBy("county_code", "settlement_code").agg(F.max("settlement_name").alias("settlement_name"))
    canonical = survivors_by_score(keyed).withColumnsRenamed({"house": "house_number", "bldg": "building", "stairs": "staircase"})
    linked = mapping.join(addresses.withColumnRenamed("id", "original_address_id"), "original_address_id")
    return {
        "address": addresses, "address_mapping": mapping, "county": county,
        "settlement": settlement.withColumn("county_id", md5_16("county_code")).withColumn("id", md5_16("county_code", "settlement_code")),
        "canonical": canonical.withColumn("county_code", F.trim("county_code")).withColumn("settlement_name", F.trim("settlement_name")),
        "address_polling_stations": linked.where("polling_station_id IS NOT NULL").select("canonical_address_id", "polling_station_id").distinct(),
        "address_postal_codes": linked.where("postal_code IS NOT NULL").select("canonical_address_id", "postal_code", "postal_code_id").distinct(),
    }


_WIDE = ("county_id", "settlement_id", "space_name_id", "space_type_id", "oevk_id", "tevk_id", "postal_code_id", "polling_station_id")
@query(f"""{_MADE}, keys AS (SELECT c, min(space_name_id) AS space_name_id, min(space_type_id) AS space_type_id, min(oevk_id) AS oevk_id, min(tevk_id) AS tevk_id, min(postal_code_id) AS postal_code_id, min(polling_station_id) AS polling_station_id FROM mapping JOIN facts USING (id) GROUP BY 1),
j AS (SELECT k.*, a.canonical_address_id, house AS house_number, bldg AS building, stairs AS staircase, full_address, county.id AS county_id, settlement.id AS settlement_id FROM canonical a JOIN county USING (county_code) JOIN settlement ON settlement.county_id = county.id AND settlement.settlement_name = a.settlement_name JOIN keys k ON k.c = a.canonical_address_id)
SELECT {uuid_of('canonical_address_id', 5)} AS id, house_number, building, staircase, full_address, CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude, CAST(NULL AS VARCHAR) AS geocoding_quality, CAST(NULL AS VARCHAR) AS geocoding_source, {', '.join(f"{uuid_of(k, 5)} AS {k}" for k in _WIDE)}
FROM j WHERE {' AND '.join(f'{k} IS NOT NULL' for k in _WIDE)}""")
def canonical_export_wide(spark, sf):
    m = made(spark, sf)
    return canonical_wide(m["canonical"], m["address_mapping"], m["address"], m["address_polling_stations"], m["county"], m["settlement"])


_NIL = lambda c: uuid_of(f"coalesce({c}, '{NIL}')", 3)
_SCORE = "CASE WHEN house_number NOT LIKE '%/%' AND building NOT IN ('', '0') THEN 100 WHEN house_number NOT LIKE '%/%' AND staircase NOT IN ('', '0') THEN 90 ELSE 50 END"
@query(f"""{_MADE}, j AS MATERIALIZED (SELECT c, f.*, {_SCORE} AS score FROM mapping JOIN facts f USING (id)),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c ORDER BY score DESC, id) AS rn FROM j) WHERE rn = 1),
n AS (SELECT c, min(original_order) AS original_order, min((original_order - 1) % 1000 + 1) AS sequence, count(DISTINCT id) AS n_originals, first(postal_code_id ORDER BY postal_code, postal_code_id) FILTER (postal_code IS NOT NULL) AS postal, min(polling_station_id) AS station FROM j GROUP BY 1)
SELECT {uuid_of('canonical_address_id', 3)} AS id, a.settlement_name, n.sequence, n.original_order, full_address, coalesce(street_name, '') AS space_name, b.space_type, {for_export('a.house')} AS house_number, {no_zeros(f"({for_export('b.building')})")} AS building, {no_zeros(f"({for_export('b.staircase')})")} AS staircase,
  {_NIL('n.postal')} AS postal_code_id, {_NIL('n.station')} AS polling_station_id, {_NIL('b.tevk_id')} AS tevk_id, {_NIL('b.county_id')} AS county_id, {_NIL('b.settlement_id')} AS settlement_id, {_NIL('b.oevk_id')} AS oevk_id, n_originals
FROM canonical a JOIN best b ON b.c = a.canonical_address_id JOIN n ON n.c = a.canonical_address_id""")
def canonical_export_v3(spark, sf):
    m = made(spark, sf)
    return canonical_served(m["canonical"], m["address_mapping"], m["address"], m["address_postal_codes"], m["address_polling_stations"])


# The other store's shape of the tables at hand: columns by name, ids, geometry.
_SWAP = lambda c: f"regexp_replace({c}, '([0-9.]+) ([0-9.]+)', '\\2 \\1', 'g')"
_POINT = "CASE WHEN center IS NOT NULL THEN 'POINT(' || split_part(center, ' ', 2) || ' ' || split_part(center, ' ', 1) || ')' END AS center_wkt"
_RING = f"CASE WHEN polygon IS NOT NULL THEN 'POLYGON((' || CASE WHEN split_part(polygon, ',', 1) = split_part(polygon, ',', -1) THEN {_SWAP('polygon')} ELSE {_SWAP('polygon')} || ',' || {_SWAP("split_part(polygon, ',', 1)")} END || '))' END AS polygon_wkt"
_key = lambda c, name=None: f"{uuid_of(c, 5)} AS {name or c}"
_SHAPES = {
    "county": [_key("id"), "county_code AS code", "county_name AS name"],
    "settlement": [_key("id"), "settlement_code AS code", "settlement_name AS name", _key("county_id")],
    "national_individual_electoral_district": [_key("id"), "oevk AS code", "district_name AS name", _POINT, _RING, _key("county_id")],
    "settlement_individual_electoral_district": [_key("id"), "tevk AS code", "district_name AS name", _key("county_id"), _key("settlement_id")],
    "polling_station": [_key("id"), "polling_station_code AS code", "polling_station_address AS address", *map(_key, ("settlement_individual_electoral_district_id", "county_id", "settlement_id", "national_individual_electoral_district_id")), "latitude", "longitude"],
    "address_polling_stations": [_key("id"), _key("canonical_address_id", "address_id"), _key("polling_station_id")],
    "canonical_address": [_key("id"), "county_code", "settlement_name", "street_name", "house_number", "building", "staircase", "full_address", "accessibility_flag", "pir_code", "latitude", "longitude", "geocoding_quality", "record_source"],
    "address_mapping": [_key("id"), *map(_key, ("original_address_id", "canonical_address_id")), "mapping_type"],
}
for _e in EXPORTED:
    if _e.name in _SHAPES:
        query(f"SELECT {', '.join(_SHAPES[_e.name])} FROM {_e.name}", f"export_{_e.name}")(lambda spark, sf, e=_e: as_exported(table(spark, sf, e.name), e))


_N = lambda name, rel, key: f"SELECT '{name}' AS table_name, count(*) AS n, sum(('0x' || substr(md5({key}), 1, 8))::BIGINT)::BIGINT AS digest FROM ({rel})"
@query(f"""{_MADE}, chosen AS MATERIALIZED (SELECT id, county_id FROM (SELECT s.*, k.county_name, row_number() OVER (PARTITION BY s.county_id ORDER BY s.settlement_code, s.id) AS rn FROM settlement s JOIN (SELECT * FROM county WHERE county_name = '{CAPITAL}' UNION ALL SELECT * FROM (SELECT * FROM county WHERE county_name <> '{CAPITAL}' ORDER BY county_code, id LIMIT 3)) k ON k.id = s.county_id)
    WHERE rn <= CASE WHEN county_name = '{CAPITAL}' THEN 3 ELSE 10 END),
a AS MATERIALIZED (SELECT * FROM facts WHERE settlement_id IN (SELECT id FROM chosen)),
m AS MATERIALIZED (SELECT * FROM mapping WHERE id IN (SELECT id FROM a))
{_N('county', 'SELECT id FROM county WHERE id IN (SELECT county_id FROM chosen)', 'id')} UNION ALL {_N('settlement', 'SELECT id FROM chosen', 'id')} UNION ALL {_N('address', 'SELECT id FROM a', 'id')}
UNION ALL {_N('postal_code', 'SELECT DISTINCT postal_code_id AS id FROM a WHERE postal_code_id IS NOT NULL', 'id')} UNION ALL {_N('address_mapping', 'SELECT id FROM m', 'id')}
UNION ALL {_N('canonical_address', 'SELECT DISTINCT c AS id FROM m', 'id')} UNION ALL {_N('address_polling_stations', "SELECT DISTINCT c || '|' || polling_station_id AS id FROM mapping JOIN facts USING (id) WHERE polling_station_id IS NOT NULL AND c IN (SELECT c FROM m)", 'id')}""")
def fk_closed_subset(spark, sf):
    """Rows and digests of the tables of a subset of settlements, closed under all references."""
    m = made(spark, sf)
    tables = {n: m[n] for n in ("county", "settlement", "address", "address_mapping", "address_polling_stations")}
    tables["postal_code"] = m["address"].select(F.col("postal_code_id").alias("id")).where("id IS NOT NULL").distinct()
    tables["canonical_address"] = m["canonical"].withColumnRenamed("canonical_address_id", "id")
    got = closed_subset(tables, chosen_settlements(m["settlement"], m["county"], CAPITAL))
    keys = {"address_mapping": F.col("original_address_id"), "address_polling_stations": F.concat_ws("|", "canonical_address_id", "polling_station_id")}
    out = None
    for name, df in got.items():
        digest = F.sum(F.conv(F.substring(F.md5(keys.get(name, F.col("id"))), 1, 8), 16, 10).cast("long"))
        one = df.agg(F.count(F.lit(1)).alias("n"), digest.alias("digest")).select(F.lit(name).alias("table_name"), "n", "digest")
        out = one if out is None else out.unionByName(one)
    return out


_S = "lower(regexp_replace(coalesce(polling_station_address, ''), '" + "|".join(X.INSTITUTIONS) + "', '', 'gi'))"
_P = X.STATION_STREET.replace("'", "''")
@query(f"""SELECT polling_station_address, CASE WHEN regexp_extract(x, '{_P}', 0) <> '' THEN trim(regexp_extract(x, '{_P}', 1)) || ' ' || trim(regexp_extract(x, '{_P}', 2)) WHEN y <> x THEN y END AS components
  FROM (SELECT DISTINCT polling_station_address, {_S} AS x, trim(regexp_replace(regexp_replace({_S}, '[,;]', ' ', 'g'), '\\s+', ' ', 'g')) AS y FROM polling_station)""")
def station_components(spark, sf):
    return table(spark, sf, "polling_station").select("polling_station_address", X.station_components("polling_station_address").alias("components")).distinct()
