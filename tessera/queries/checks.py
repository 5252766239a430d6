"""Queries on checks, profiles and the SQL surface, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import geo as G
from tessera.functions.registry import register_functions
from tessera.operators.constraints import Constraints, violations
from tessera.operators.dedup import as_json, dedup_report, report_row, with_canonical_id
from tessera.operators.export import split_part
from tessera.operators.tables import count_distinct_with_null, running_count
from tessera.plans.pipeline import run, whole_run
from tessera.queries.addresses import _KEYED as _KEYED_ROWS
from tessera.session import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


CONSTRAINTS = {
    "address_mapping": Constraints(("id", "original_address_id"), (("original_address_id", "canonical_address_id"),), (("original_address_id", "canonical_address", "id"),)),
    "canonical_address": Constraints(("id", "full_address"), (("id",),)),
    "polling_station": Constraints(("settlement_id",), (("id",),), (("settlement_id", "settlement", "id"),)),
}


def _n(t: str, label: str, sql: str) -> str:
    return f"SELECT '{t}' AS table_name, '{label}' AS constraint_name, ({sql}) AS n"


@query(" UNION ALL ".join([
    _n("address_mapping", "not null id", "SELECT count(*) FROM address_mapping WHERE id IS NULL"),
    _n("address_mapping", "not null original_address_id", "SELECT count(*) FROM address_mapping WHERE original_address_id IS NULL"),
    _n("address_mapping", "unique original_address_id, canonical_address_id", "SELECT count(*) FROM (SELECT 1 FROM address_mapping GROUP BY original_address_id, canonical_address_id HAVING count(*) > 1)"),
    _n("address_mapping", "original_address_id references canonical_address.id", "SELECT count(*) FROM address_mapping m WHERE original_address_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM canonical_address c WHERE c.id = m.original_address_id)"),
    _n("canonical_address", "not null id", "SELECT count(*) FROM canonical_address WHERE id IS NULL"),
    _n("canonical_address", "not null full_address", "SELECT count(*) FROM canonical_address WHERE full_address IS NULL"),
    _n("canonical_address", "unique id", "SELECT count(*) FROM (SELECT 1 FROM canonical_address GROUP BY id HAVING count(*) > 1)"),
    _n("polling_station", "not null settlement_id", "SELECT count(*) FROM polling_station WHERE settlement_id IS NULL"),
    _n("polling_station", "unique id", "SELECT count(*) FROM (SELECT 1 FROM polling_station GROUP BY id HAVING count(*) > 1)"),
    _n("polling_station", "settlement_id references settlement.id", "SELECT count(*) FROM polling_station p WHERE settlement_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM settlement s WHERE s.id = p.settlement_id)"),
]))
def constraint_violations(spark, sf):
    return violations({n: table(spark, sf, n) for n in ("address_mapping", "canonical_address", "polling_station", "settlement")}, CONSTRAINTS)


@query("SELECT substr(md5(concat_ws('|', coalesce(settlement_name, ''), coalesce(street_name, ''))), 1, 16) AS id, try_cast(regexp_extract(trim(coalesce(house_number, '')), '^([0-9]+)', 1) AS INTEGER) AS number, max(CASE geocoding_quality WHEN 'exact' THEN 3 WHEN 'street' THEN 2 WHEN 'settlement' THEN 1 ELSE 0 END) AS best FROM canonical_address GROUP BY 1, 2")
def sql_functions(spark, sf):
    """SQL text over a temporary view, with registered functions."""
    register_functions(spark)
    return spark.sql(
        "SELECT address_id(settlement_name, street_name) AS id, house_int(house_number) AS number, max(quality_rank(geocoding_quality)) AS best FROM {canonical} GROUP BY ALL",
        canonical=table(spark, sf, "canonical_address"))


_H = lambda *parts: f"substr(md5({" || '|' || ".join(parts)}), 1, 16)"
_PARTS = ("county_code", "settlement_code", "oevk_code", "tevk_code", "postal_code", "polling_station_address", "street_name", "street_type", "house_number", "building", "staircase")
@query(f"""SELECT DISTINCT {', '.join(_PARTS)}, {_H('county_code')} AS county_id, {_H('county_code', 'settlement_code')} AS settlement_id, {_H('county_code', 'oevk_code')} AS oevk_id, {_H('county_code', 'settlement_code', "coalesce(tevk_code, '-')")} AS tevk_id,
  {_H('postal_code')} AS postal_code_id, {_H(_H('postal_code'), _H('county_code', 'settlement_code'))} AS link_id, {_H('county_code', 'settlement_code', 'oevk_code', "coalesce(tevk_code, '')", 'polling_station_address')} AS station_id,
  {_H('county_code', 'settlement_code', 'street_name', 'street_type', 'house_number', "coalesce(building, '')", "coalesce(staircase, '')", 'postal_code')} AS address_id, replace(street_name, chr(39), chr(39) || chr(39)) AS escaped FROM staging_korzet""")
def sql_hash_ids(spark, sf):
    """Ids by the functions that SQL text can call; a null part gives no id, but for those that may be left out."""
    register_functions(spark)
    return spark.sql(
        f"""SELECT DISTINCT {', '.join(_PARTS)}, hash_county_id(county_code) AS county_id, hash_settlement_id(county_code, settlement_code) AS settlement_id, hash_oevk_id(county_code, oevk_code) AS oevk_id, hash_tevk_id(county_code, settlement_code, tevk_code) AS tevk_id,
        hash_postal_code_id(postal_code) AS postal_code_id, hash_postal_code_settlement_id(hash_postal_code_id(postal_code), hash_settlement_id(county_code, settlement_code)) AS link_id, hash_polling_station_id(county_code, settlement_code, oevk_code, tevk_code, polling_station_address) AS station_id,
        hash_address_id(county_code, settlement_code, street_name, street_type, house_number, building, staircase, postal_code) AS address_id, sql_escape(street_name) AS escaped FROM {{s}}""",
        s=table(spark, sf, "staging_korzet"))


@query("SELECT row_id, count(*) OVER (PARTITION BY trim(gate_code) ORDER BY run_tag, row_id) AS nth FROM staging_korzet")
def running_counts(spark, sf):
    s = table(spark, sf, "staging_korzet").select("row_id", "run_tag", F.trim("gate_code").alias("gate_code"))
    return running_count(s, ["gate_code"], ["run_tag", "row_id"]).select("row_id", F.col("nth").cast("long").alias("nth"))


@query("SELECT county_code, count(DISTINCT tevk_code) + max(CASE WHEN tevk_code IS NULL THEN 1 ELSE 0 END) AS n_tevk, count(DISTINCT street_type) + max(CASE WHEN street_type IS NULL THEN 1 ELSE 0 END) AS n_types FROM staging_korzet GROUP BY 1")
def unique_with_null(spark, sf):
    s = table(spark, sf, "staging_korzet")
    return s.groupBy("county_code").agg(count_distinct_with_null(F.col("tevk_code")).alias("n_tevk"), count_distinct_with_null(F.col("street_type")).alias("n_types"))


@query("SELECT DISTINCT polling_station_address, split_part(polling_station_address, ' ', 1) AS first, split_part(polling_station_address, ' ', -1) AS last, split_part(polling_station_address, ',', 2) AS second FROM polling_station")
def split_parts(spark, sf):
    a = F.col("polling_station_address")
    return table(spark, sf, "polling_station").select("polling_station_address", split_part(a, " ", 1).alias("first"), split_part(a, " ", -1).alias("last"), split_part(a, ",", 2).alias("second")).distinct()


@query("SELECT * FROM canonical_address c WHERE EXISTS (SELECT 1 FROM address_mapping m JOIN address_polling_stations s ON s.canonical_address_id = m.canonical_address_id WHERE m.original_address_id = c.id)")
def semi_join_over_join(spark, sf):
    """Records whose group has a station: a semi join against a join."""
    m = table(spark, sf, "address_mapping").select(F.col("original_address_id").alias("id"), "canonical_address_id")
    held = m.join(table(spark, sf, "address_polling_stations").select("canonical_address_id"), "canonical_address_id", "left_semi").select("id")
    return table(spark, sf, "canonical_address").join(held, "id", "left_semi")


@query("SELECT ps.n AS sequences, c.chunk, count(*) AS n FROM (SELECT (count(*) + 999) // 1000 AS n FROM staging_korzet) ps, (SELECT (row_id % 1000003) // 100 AS chunk FROM staging_korzet) c GROUP BY 1, 2")
def chunk_counts(spark, sf):
    """Number of chunks of a thousand that the rows fill, rounded up, and the rows of each chunk of ids."""
    s = table(spark, sf, "staging_korzet")
    total = s.agg(F.ceil(F.count(F.lit(1)) / 1000).alias("sequences"))
    return s.groupBy(F.expr("(row_id % 1000003) DIV 100").alias("chunk")).agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(total))  # one row


@query("SELECT count(*) AS total_addresses, count(*) - count(DISTINCT c) AS duplicates_found, count(DISTINCT c) AS canonical_addresses_created, CASE WHEN count(*) > 0 AND count(DISTINCT c) = 0 THEN 'partial' ELSE 'completed' END AS status, substr(md5('run'), 1, 16) AS id FROM (SELECT canonical_address_id AS c FROM (" + _KEYED_ROWS + "))")
def dedup_report_row(spark, sf):
    """The report of an entity resolution with its status, as it is given out in JSON, without times."""
    r = as_json(report_row(dedup_report(with_canonical_id(table(spark, sf, "staging_korzet"))), "run", 0))
    j = F.from_json("json", "id string, total_addresses long, duplicates_found long, canonical_addresses_created long, status string")
    return r.select(j.alias("j")).select("j.total_addresses", "j.duplicates_found", "j.canonical_addresses_created", "j.status", "j.id")


@query("SELECT row_id, street_name FROM staging_korzet WHERE run_tag = '20251001' AND street_name ILIKE '%erdő%'")
def run_filter_ilike(spark, sf):
    """A run picked by a bound parameter, and a search by part of a name."""
    return spark.sql("SELECT row_id, street_name FROM {s} WHERE run_tag = :tag AND street_name ILIKE :part", args={"tag": "20251001", "part": "%erdő%"}, s=table(spark, sf, "staging_korzet"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem ORDER BY l_orderkey, l_linenumber LIMIT 1000 OFFSET 500")
def page_of_rows(spark, sf):
    """One page of an ordered table: the limit is the feature."""
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber").orderBy("l_orderkey", "l_linenumber").offset(500).limit(1000)


@query("SELECT id, 'settlement' AS kind FROM settlement UNION ALL SELECT id, 'station' FROM polling_station UNION ALL SELECT id, 'district' FROM settlement_individual_electoral_district")
def union_of_frames(spark, sf):
    t = lambda n, k: table(spark, sf, n).select("id", F.lit(k).alias("kind"))
    return t("settlement", "settlement").unionByName(t("polling_station", "station")).unionByName(t("settlement_individual_electoral_district", "district"))


@query("SELECT s.id, s.settlement_name FROM settlement s WHERE s.county_id = (SELECT min(id) FROM county WHERE county_code = '12')")
def scalar_subquery(spark, sf):
    one = table(spark, sf, "county").where("county_code = '12'").agg(F.min("id").alias("county_id"))
    return table(spark, sf, "settlement").join(F.broadcast(one), "county_id").select("id", "settlement_name")  # one row


@query("SELECT DISTINCT cache_key, CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN 'Point' END AS kind, CASE WHEN latitude IS NOT NULL THEN longitude END AS x, CASE WHEN longitude IS NOT NULL THEN latitude END AS y FROM geocoding_cache")
def geojson_points(spark, sf):
    g = table(spark, sf, "geocoding_cache").withColumn("j", G.geojson_point(F.col("latitude"), F.col("longitude")))
    j = F.from_json("j", "type string, coordinates array<double>")
    return g.select("cache_key", j["type"].alias("kind"), F.get(j["coordinates"], 0).alias("x"), F.get(j["coordinates"], 1).alias("y")).distinct()


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in ("county", "settlement", "polling_station", "canonical_address", "address_mapping", "address_polling_stations", "geocoding_cache")))
def table_row_counts(spark, sf):
    parts = [table(spark, sf, n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("table_name"), "n") for n in ("county", "settlement", "polling_station", "canonical_address", "address_mapping", "address_polling_stations", "geocoding_cache")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("SELECT count(*) FILTER (run_tag IS NULL) AS run_tag, count(*) FILTER (tevk_code IS NULL) AS tevk_code, count(*) FILTER (street_type IS NULL) AS street_type, count(*) FILTER (gate_code IS NULL) AS gate_code, count(*) AS n FROM staging_korzet")
def null_counts(spark, sf):
    cols = ["run_tag", "tevk_code", "street_type", "gate_code"]
    return table(spark, sf, "staging_korzet").agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in cols), F.count(F.lit(1)).alias("n"))


@query("SELECT o_custkey, count(*) AS n, min(o_orderdate) AS first_date, arg_max(o_orderkey, (o_totalprice, o_orderkey)) AS dearest FROM orders GROUP BY 1")
def pick_by_rank(spark, sf):
    o = table(spark, sf, "orders").groupBy("o_custkey")
    return o.agg(F.count(F.lit(1)).alias("n"), F.min("o_orderdate").alias("first_date"), F.max_by("o_orderkey", F.struct("o_totalprice", "o_orderkey")).alias("dearest"))


@query("SELECT 'county' AS table_name, count(DISTINCT trim(county_code)) AS n FROM staging_korzet WHERE trim(county_code) <> '' UNION ALL SELECT 'postal_code', count(DISTINCT trim(postal_code)) FROM staging_korzet WHERE trim(postal_code) NOT IN ('', '0') UNION ALL SELECT 'settlement', count(*) FROM (SELECT DISTINCT trim(county_code), trim(settlement_code) FROM staging_korzet WHERE trim(settlement_code) <> '')")
def pipeline_entities(spark, sf):
    """Row counts of entity tables made by the pipeline."""
    made = run(table(spark, sf, "staging_korzet")).tables
    one = lambda n: made[n].agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("table_name"), "n")
    return one("county").unionByName(one("settlement")).unionByName(one("postal_code"))


@query()
def pipeline_tables(spark, sf):
    """Rows of every table that the whole run makes, and a digest of all their columns, so that all of them are computed."""
    given = {"staging": table(spark, sf, "staging_korzet"), "earlier": table(spark, sf, "canonical_address"), "cache": table(spark, sf, "geocoding_cache")}
    out = None
    for name, df in whole_run(**given).tables.items():
        if name not in given and name != "links":
            one = df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*df.columns)).alias("digest")).select(F.lit(name).alias("table_name"), "n", "digest")
            out = one if out is None else out.unionByName(one)
    return out
