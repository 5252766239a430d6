"""Queries on coordinates, links between tables, serving tables and checks, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import geo as G
from tessera.functions.keys import md5_16, strict_cache_key, uuid3
from tessera.functions.textops import export_score, house_int, plain_address, without_parentheses
from tessera.operators.geocode import QUALITY_RANK, answer_place, best_fuzzy, better_wins, cache_hits, cache_misses, crowded_points, interpolate, quality_by_keyword, quality_of_osm, quality_of_result_type, quality_rank, station_places, wants_retry
from tessera.operators.proximity import nearest, points_within, regions_of, regions_overlap
from tessera.operators.rejects import STAGING_COLUMNS
from tessera.operators.serve import canonical_export, canonical_with_lists, resolved_keys
from tessera.operators.tables import deterministic_sample, differences, first_by, last_by, orphans_of, verify_counts
from tessera.queries.addresses import _uuid_sql, id16, staging, t
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


_RANK = "CASE quality WHEN 'exact' THEN 3 WHEN 'street' THEN 2 WHEN 'settlement' THEN 1 ELSE 0 END"
_RANK_OF = lambda c: f"CASE {c} WHEN 'exact' THEN 3 WHEN 'street' THEN 2 WHEN 'settlement' THEN 1 ELSE 0 END"
# One cache row for each canonical address: the best quality, then the smallest key.
_CACHE = f"(SELECT * FROM (SELECT canonical_address_id, cache_key, latitude, longitude, quality, row_number() OVER (PARTITION BY canonical_address_id ORDER BY {_RANK} DESC, cache_key, created_at) AS n FROM geocoding_cache WHERE canonical_address_id IS NOT NULL) WHERE n = 1)"
_ADDR = "(SELECT id AS canonical_address_id, max(county_code) AS county_code, max(settlement_name) AS settlement_name, max(street_name) AS street_name, max(house_number) AS house_number, max(latitude) AS latitude, max(longitude) AS longitude, coalesce(max(geocoding_quality), 'failed') AS quality FROM canonical_address GROUP BY id)"


def cache(spark, sf) -> DataFrame:
    g = table(spark, sf, "geocoding_cache").where("canonical_address_id IS NOT NULL")
    return first_by(g, ["canonical_address_id"], [quality_rank(F.col("quality")).desc(), F.asc("cache_key"), F.asc("created_at")]).select("canonical_address_id", "cache_key", "latitude", "longitude", "quality")


def addresses(spark, sf) -> DataFrame:
    c = ["county_code", "settlement_name", "street_name", "house_number", "latitude", "longitude"]
    return table(spark, sf, "canonical_address").groupBy(F.col("id").alias("canonical_address_id")).agg(*(F.max(x).alias(x) for x in c), F.coalesce(F.max("geocoding_quality"), F.lit("failed")).alias("quality"))


@query(f"SELECT a.canonical_address_id, g.latitude, g.longitude, g.quality, 'cache' AS source FROM {_ADDR} a JOIN {_CACHE} g USING (canonical_address_id) WHERE g.quality <> 'failed'")
def cache_hit_join(spark, sf):
    return cache_hits(addresses(spark, sf).select("canonical_address_id"), cache(spark, sf), "canonical_address_id")


@query(f"SELECT canonical_address_id FROM {_ADDR} WHERE canonical_address_id NOT IN (SELECT canonical_address_id FROM {_CACHE} WHERE quality <> 'failed')")
def cache_miss_anti(spark, sf):
    return cache_misses(addresses(spark, sf).select("canonical_address_id"), cache(spark, sf), "canonical_address_id")


@query(f"SELECT a.canonical_address_id, CASE WHEN {_RANK_OF('g.quality')} > {_RANK_OF('a.quality')} THEN g.latitude ELSE a.latitude END AS latitude, CASE WHEN {_RANK_OF('g.quality')} > {_RANK_OF('a.quality')} THEN g.longitude ELSE a.longitude END AS longitude, CASE WHEN {_RANK_OF('g.quality')} > {_RANK_OF('a.quality')} THEN g.quality ELSE a.quality END AS quality FROM {_ADDR} a LEFT JOIN {_CACHE} g USING (canonical_address_id)")
def better_wins_merge(spark, sf):
    a = addresses(spark, sf).select("canonical_address_id", "latitude", "longitude", "quality")
    return better_wins(a, cache(spark, sf), "canonical_address_id", ["latitude", "longitude"])


@query(f"SELECT canonical_address_id, cache_key, quality FROM {_CACHE}")
def best_quality_per_key(spark, sf):
    return cache(spark, sf).select("canonical_address_id", "cache_key", "quality")


@query("SELECT cache_key, osm_type, CASE WHEN coalesce(osm_type, '') = 'node' OR coalesce(osm_id % 40, 30) = 30 THEN 'exact' WHEN coalesce(osm_type, '') = 'way' OR osm_id % 40 = 26 THEN 'street' WHEN coalesce(osm_type, '') = 'relation' OR osm_id % 40 < 20 THEN 'settlement' ELSE 'street' END AS class FROM geocoding_cache")
def quality_classify(spark, sf):
    # The cache has no class and rank columns: its object kinds and numbers stand in for them.
    g = table(spark, sf, "geocoding_cache")
    kind = F.when(F.col("osm_type") == "node", "house")
    place = F.when(F.col("osm_type") == "way", "highway").when(F.col("osm_type") == "relation", "place")
    return g.select("cache_key", "osm_type", quality_of_osm(kind, place, F.col("osm_id") % 40).alias("class"))


@query("SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING') THEN 'exact' WHEN c_mktsegment = 'MACHINERY' THEN 'street' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'settlement' WHEN c_acctbal > 6000 THEN 'exact' WHEN c_acctbal > 3000 THEN 'street' WHEN c_acctbal > 0 THEN 'settlement' ELSE 'street' END AS class FROM customer")
def quality_classify_result_type(spark, sf):
    c = table(spark, sf, "customer")
    kind = F.when(F.col("c_mktsegment") == "BUILDING", "houseNumber").when(F.col("c_mktsegment") == "MACHINERY", "street").when(F.col("c_mktsegment") == "HOUSEHOLD", "locality")
    b = F.col("c_acctbal")
    return c.select("c_custkey", quality_of_result_type(kind, F.when(b > 6000, 1), F.when(b > 3000, 1), F.when(b > 0, 1)).alias("class"))


_PTS = f"(SELECT canonical_address_id AS id, settlement_name || '|' || county_code AS area, street_name AS street, try_cast(regexp_extract({t('house_number')}, '^([0-9]+)', 1) AS INTEGER) AS number, round(latitude, 6) AS lat, round(longitude, 6) AS lon, CASE WHEN quality = 'exact' AND latitude IS NOT NULL THEN 'exact' ELSE 'street' END AS quality FROM {_ADDR})"


def _street_points(spark, sf):
    a = addresses(spark, sf)
    return a.select(F.col("canonical_address_id").alias("id"), F.concat("settlement_name", F.lit("|"), "county_code").alias("area"), F.col("street_name").alias("street"), house_int("house_number").alias("number"), F.round("latitude", 6).alias("lat"), F.round("longitude", 6).alias("lon"), F.when((F.col("quality") == "exact") & F.col("latitude").isNotNull(), "exact").otherwise("street").alias("quality"))


@query(f"""
WITH p AS (SELECT * FROM {_PTS} WHERE number IS NOT NULL AND street <> ''),
e AS (SELECT * FROM p WHERE quality = 'exact' AND lat IS NOT NULL AND lon IS NOT NULL),
ok AS (SELECT area, street FROM e GROUP BY 1, 2 HAVING count(*) >= 2),
s AS (SELECT p.* FROM p JOIN ok USING (area, street) WHERE quality = 'street'),
lo AS (SELECT s.id, arg_max(struct_pack(n := e.number, lat := e.lat, lon := e.lon), (e.number, e.id)) AS lo FROM s JOIN e ON e.area = s.area AND e.street = s.street AND e.number <= s.number GROUP BY 1),
hi AS (SELECT s.id, arg_min(struct_pack(n := e.number, lat := e.lat, lon := e.lon), (e.number, e.id)) AS hi FROM s JOIN e ON e.area = s.area AND e.street = s.street AND e.number > s.number GROUP BY 1)
SELECT s.id, round(CASE WHEN lo IS NOT NULL AND hi IS NOT NULL THEN lo.lat + (s.number - lo.n) / (hi.n - lo.n)::DOUBLE * (hi.lat - lo.lat) WHEN lo IS NOT NULL THEN lo.lat + 0.0001 * (s.number - lo.n) ELSE hi.lat END, 7) AS new_latitude,
  round(CASE WHEN lo IS NOT NULL AND hi IS NOT NULL THEN lo.lon + (s.number - lo.n) / (hi.n - lo.n)::DOUBLE * (hi.lon - lo.lon) WHEN lo IS NOT NULL THEN lo.lon + 0.0001 * (s.number - lo.n) ELSE hi.lon END, 7) AS new_longitude,
  CASE WHEN lo IS NOT NULL AND hi IS NOT NULL THEN 'interpolated (' || lo.n || '-' || hi.n || ')' ELSE 'extrapolated (nearest: ' || coalesce(lo.n, hi.n) || ')' END AS new_source, 'interpolated' AS new_quality
FROM s LEFT JOIN lo ON lo.id = s.id LEFT JOIN hi ON hi.id = s.id WHERE lo IS NOT NULL OR hi IS NOT NULL""")
def street_interpolation(spark, sf):
    p = _street_points(spark, sf).where("street != ''")
    r = interpolate(p, ["area", "street"], "number", "lat", "lon", "quality", "id")
    return r.select("id", F.round("new_latitude", 7).alias("new_latitude"), F.round("new_longitude", 7).alias("new_longitude"), "new_source", "new_quality")


_AREA = "county_code || '|' || settlement_name"
@query(f"""
WITH a AS (SELECT DISTINCT {_AREA} AS area, trim(street_name) AS a FROM canonical_address WHERE trim(street_name) <> ''),
b AS (SELECT DISTINCT trim(county_code) || '|' || trim(settlement_name) AS area, trim(street_name) AS b FROM staging_korzet WHERE trim(street_name) <> ''),
s AS (SELECT area, a, b, 1 - levenshtein(lower(a), lower(b)) / greatest(length(a), length(b))::DOUBLE AS similarity FROM a JOIN b USING (area))
SELECT area, a AS street, b AS match, round(similarity, 6) AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY area, a ORDER BY similarity DESC, b) AS n FROM s WHERE similarity >= 0.6) WHERE n = 1""")
def fuzzy_best_match(spark, sf):
    """The most similar street of a settlement's staging records for every street of its canonical ones; distinct names only."""
    area = lambda c, n: F.concat(c, F.lit("|"), n).alias("area")
    left = table(spark, sf, "canonical_address").select(area(F.col("county_code"), F.col("settlement_name")), F.trim("street_name").alias("a")).where("a != '' AND area IS NOT NULL").distinct()
    right = staging(spark, sf).select(area(F.trim("county_code"), F.trim("settlement_name")), F.trim("street_name").alias("b")).where("b != '' AND area IS NOT NULL").distinct()
    r = best_fuzzy(left.withColumn("id", F.struct("area", "a")), right, "area", "a", "b", "id", "b", 0.6)
    return r.select(F.col("left_id.area").alias("area"), F.col("left_id.a").alias("street"), F.col("right_id").alias("match"), F.round("similarity", 6).alias("similarity"))


@query("SELECT county_code, settlement_name, round(avg(latitude), 8) AS latitude, round(avg(longitude), 8) AS longitude, count(*) AS n FROM canonical_address WHERE geocoding_quality IN ('exact', 'street') AND latitude IS NOT NULL GROUP BY 1, 2")
def settlement_centroid(spark, sf):
    c = table(spark, sf, "canonical_address").where("geocoding_quality IN ('exact', 'street') AND latitude IS NOT NULL")
    return c.groupBy("county_code", "settlement_name").agg(F.round(F.avg("latitude"), 8).alias("latitude"), F.round(F.avg("longitude"), 8).alias("longitude"), F.count(F.lit(1)).alias("n"))


_FOLD = lambda c: f"regexp_replace(translate(lower(coalesce({c}, '')), 'áéíóöőúüű', 'aeiooouuu'), '[^a-z0-9]', '', 'g')"
_REF = lambda c: f"nullif(lower(regexp_replace({c}, '^\\s+|\\s+$', '', 'g')), '')"
_STREET = r"'([a-záéíóöőúüű\s]+(?:utca|út|tér|köz|körút|sétány|park|sor))\s*(\d+[a-z\-/\.]*)'"
_PARTS = lambda c: f"CASE WHEN regexp_extract(lower({c}), {_STREET}, 1) <> '' THEN {_FOLD(f'regexp_extract(lower({c}), {_STREET}, 0)')} ELSE '' END"
@query(f"""
WITH s0 AS (SELECT * FROM (SELECT id, polling_station_address AS address, latitude, longitude, {_REF('settlement_id')} AS sid, {_REF('county_id')} AS cid, row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC NULLS LAST, polling_station_address DESC NULLS LAST, latitude DESC NULLS LAST, longitude DESC NULLS LAST, settlement_id DESC NULLS LAST, county_id DESC NULLS LAST) AS n FROM polling_station WHERE id IS NOT NULL) WHERE n = 1),
se AS (SELECT * FROM (SELECT {_REF('id')} AS sid, {_FOLD('settlement_name')} AS name, {_REF('county_id')} AS scid, row_number() OVER (PARTITION BY {_REF('id')} ORDER BY loaded_at DESC NULLS LAST, {_FOLD('settlement_name')} DESC, {_REF('county_id')} DESC NULLS LAST) AS n FROM settlement) WHERE n = 1),
co AS (SELECT * FROM (SELECT {_REF('id')} AS cid, trim(county_code) AS code, row_number() OVER (PARTITION BY {_REF('id')} ORDER BY loaded_at DESC NULLS LAST, county_code DESC NULLS LAST) AS n FROM county) WHERE n = 1),
p AS (SELECT * FROM (SELECT id, trim(county_code) AS code, {_FOLD('settlement_name')} AS name, full_address, geocoding_quality AS quality, latitude, longitude, row_number() OVER (PARTITION BY id ORDER BY geocoding_quality, latitude, longitude, full_address NULLS FIRST) AS n FROM canonical_address WHERE id IS NOT NULL AND geocoding_quality IN ('exact', 'street') AND latitude IS NOT NULL AND longitude IS NOT NULL) WHERE n = 1),
o AS (SELECT name, min(code) AS only FROM p GROUP BY 1 HAVING count(DISTINCT code) = 1),
st AS (SELECT s0.id, s0.latitude, s0.longitude, coalesce(c1.code, c2.code, o.only) || '|' || se.name AS area, trim(regexp_replace(coalesce(address, ''), '\\s*\\([^)]*\\)\\s*', ' ', 'g')) AS address
  FROM s0 LEFT JOIN se USING (sid) LEFT JOIN co c1 ON c1.cid = s0.cid LEFT JOIN co c2 ON c2.cid = se.scid LEFT JOIN o ON o.name = se.name),
k AS (SELECT *, code || '|' || name AS area, {_FOLD('full_address')} AS whole, {_PARTS('full_address')} AS parts FROM p),
a AS (SELECT *, {_FOLD('address')} AS whole, {_PARTS('address')} AS parts FROM st WHERE latitude IS NULL OR longitude IS NULL),
sim AS (SELECT a.id, k.id AS m, k.quality, k.latitude, k.longitude, 1 - levenshtein(lower(a.address), lower(k.full_address)) / greatest(length(a.address), length(k.full_address)) AS similarity FROM a JOIN k USING (area) WHERE a.address <> '' AND k.full_address <> ''),
c AS (SELECT 0 AS rung, id, 'exact' AS quality, 'station' AS source, NULL AS matched_id, NULL::DOUBLE AS similarity, latitude, longitude FROM st WHERE latitude IS NOT NULL AND longitude IS NOT NULL
  UNION ALL SELECT 1, a.id, k.quality, 'canonical_whole', k.id, 1, k.latitude, k.longitude FROM a JOIN k ON a.area = k.area AND a.whole = k.whole WHERE a.whole <> ''
  UNION ALL SELECT 2, a.id, k.quality, 'canonical_parts', k.id, 1, k.latitude, k.longitude FROM a JOIN k ON a.area = k.area AND a.parts = k.parts WHERE a.parts <> ''
  UNION ALL SELECT 3, id, quality, 'canonical_similar', m, round(similarity, 6), latitude, longitude FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY similarity DESC, m) AS n FROM sim WHERE similarity >= 0.6) WHERE n = 1
  UNION ALL SELECT 4, a.id, 'settlement', 'settlement_centroid', NULL, NULL, g.latitude, g.longitude FROM a JOIN (SELECT area, sum(CAST(latitude AS DECIMAL(18,10)))::DOUBLE / count(*) AS latitude, sum(CAST(longitude AS DECIMAL(18,10)))::DOUBLE / count(*) AS longitude FROM k GROUP BY 1) g USING (area)),
t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY rung, matched_id, latitude, longitude) AS n FROM c) WHERE n = 1)
SELECT st.id, coalesce(t.quality, 'failed') AS quality, source, matched_id, similarity, t.latitude AS latitude, t.longitude AS longitude FROM st LEFT JOIN t USING (id)""")
def station_ladder(spark, sf):
    """Where each station is, and by which rung of the ladder it was found."""
    return station_places(*(table(spark, sf, n) for n in ("polling_station", "settlement", "county", "canonical_address")))


_MINIMA = ("failed", "settlement", "street", "exact")
@query(f"SELECT m.minimum, cache_key, quality FROM geocoding_cache, (VALUES {', '.join(f"('{m}')" for m in _MINIMA)}) m(minimum) WHERE quality = 'failed' OR (quality = 'settlement' AND m.minimum IN ('settlement', 'street', 'exact')) OR (quality = 'street' AND m.minimum IN ('street', 'exact'))")
def retry_selection(spark, sf):
    """What is looked up again for each of the minimum qualities that may be configured."""
    g = table(spark, sf, "geocoding_cache").select("cache_key", "quality", F.explode(F.array(*map(F.lit, _MINIMA))).alias("minimum"))
    return g.where(wants_retry(F.col("quality"), F.col("minimum"))).select("minimum", "cache_key", "quality")


_REKEY = f"SELECT md5(coalesce(a.settlement_name, '') || '|' || coalesce(a.street_name, '') || '|' || coalesce(a.house_number, '')) AS new_key, g.cache_key, g.quality, {_RANK_OF('g.quality')} AS rank FROM geocoding_cache g JOIN {_ADDR} a USING (canonical_address_id)"
@query(f"SELECT new_key, cache_key, quality FROM (SELECT *, row_number() OVER (PARTITION BY new_key ORDER BY rank DESC, cache_key, quality) AS n FROM ({_REKEY})) WHERE n = 1")
def cache_rekey(spark, sf):
    g = table(spark, sf, "geocoding_cache").select("canonical_address_id", "cache_key", "quality").join(addresses(spark, sf).drop("quality"), "canonical_address_id")
    key = F.md5(F.concat_ws("|", *(F.coalesce(c, F.lit("")) for c in ("settlement_name", "street_name", "house_number"))))
    best = g.groupBy(key.alias("new_key")).agg(F.min(F.struct((-quality_rank(F.col("quality"))).alias("r"), "cache_key", "quality")).alias("b"))
    return best.select("new_key", F.col("b.cache_key").alias("cache_key"), F.col("b.quality").alias("quality"))


@query("SELECT canonical_address_id, min(polling_station_id) AS polling_station_id, min(id) AS link_id FROM address_polling_stations GROUP BY 1 HAVING min(polling_station_id) IS NOT NULL AND min(id) IS NOT NULL")
def fk_min_resolution(spark, sf):
    links = table(spark, sf, "address_polling_stations").select("canonical_address_id", "polling_station_id", F.col("id").alias("link_id"))
    return resolved_keys(links, "canonical_address_id", ["polling_station_id", "link_id"])


@query("""SELECT c.canonical_address_id, (SELECT string_agg(DISTINCT s.polling_station_id, ',' ORDER BY s.polling_station_id) FROM address_polling_stations s WHERE s.canonical_address_id = c.canonical_address_id) AS station_ids,
  (SELECT count(DISTINCT s.polling_station_id) FROM address_polling_stations s WHERE s.canonical_address_id = c.canonical_address_id) AS n_stations,
  (SELECT count(DISTINCT m.original_address_id) FROM address_mapping m WHERE m.canonical_address_id = c.canonical_address_id) AS n_originals FROM (SELECT DISTINCT id AS canonical_address_id FROM canonical_address) c""")
def fanout_count_distinct(spark, sf):
    c = table(spark, sf, "canonical_address").select(F.col("id").alias("canonical_address_id")).distinct()
    return canonical_with_lists(c, table(spark, sf, "address_polling_stations").where("polling_station_id IS NOT NULL"), table(spark, sf, "address_mapping"))


_DET = "(SELECT id, max(struct_pack(a := full_address, b := house_number, c := building, d := staircase)) AS d FROM canonical_address GROUP BY id)"
@query(f"""WITH d AS (SELECT id, full_address, coalesce(house_number, '') AS h, coalesce(building, '') AS b, coalesce(staircase, '') AS s FROM (SELECT DISTINCT id, full_address, house_number, building, staircase FROM canonical_address)),
j AS (SELECT DISTINCT m.canonical_address_id, m.original_address_id AS id, d.full_address, CASE WHEN d.id IS NULL THEN NULL WHEN h NOT LIKE '%/%' AND b NOT IN ('', '0') THEN 100 WHEN h NOT LIKE '%/%' AND s NOT IN ('', '0') THEN 90 ELSE 50 END AS score FROM (SELECT DISTINCT canonical_address_id, original_address_id FROM address_mapping) m LEFT JOIN d ON d.id = m.original_address_id),
g AS (SELECT canonical_address_id, count(*) AS n_originals, first(id ORDER BY score DESC NULLS LAST, id) FILTER (score IS NOT NULL) AS best_id, first(full_address ORDER BY score DESC NULLS LAST, id) FILTER (score IS NOT NULL) AS full_address FROM j GROUP BY 1)
SELECT g.canonical_address_id, n_originals, best_id, full_address, coalesce(u.u, '00000000-0000-0000-0000-000000000000') AS export_id FROM g LEFT JOIN (SELECT DISTINCT id, {_uuid_sql(3)} AS u FROM canonical_address) u ON u.id = g.best_id""")
def canonical_export_best(spark, sf):
    return canonical_export(table(spark, sf, "address_mapping"), table(spark, sf, "canonical_address"))


@query("SELECT c.id, coalesce(k.full_address, c.full_address) AS full_address FROM (SELECT id, max(full_address) AS full_address FROM canonical_address GROUP BY 1) c LEFT JOIN (SELECT original_address_id AS id, max(canonical_address_id) AS canonical FROM address_mapping GROUP BY 1) m USING (id) LEFT JOIN (SELECT id AS canonical, max(full_address) AS full_address FROM canonical_address GROUP BY 1) k USING (canonical)")
def original_address_export(spark, sf):
    c = table(spark, sf, "canonical_address").groupBy("id").agg(F.max("full_address").alias("full_address"))
    m = table(spark, sf, "address_mapping").groupBy(F.col("original_address_id").alias("id")).agg(F.max("canonical_address_id").alias("canonical"))
    k = c.select(F.col("id").alias("canonical"), F.col("full_address").alias("preferred"))
    return c.join(m, "id", "left").join(k, "canonical", "left").select("id", F.coalesce("preferred", "full_address").alias("full_address"))


@query("SELECT l_orderkey, l_linenumber, o_orderstatus, c_name, c.n_name AS customer_nation, cr.r_name AS customer_region, p_name, s_name, sn.n_name AS supplier_nation FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation c ON c.n_nationkey = c_nationkey JOIN region cr ON cr.r_regionkey = c.n_regionkey JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey JOIN nation sn ON sn.n_nationkey = s_nationkey")
def wide_denormalised_view(spark, sf):
    T = lambda n: table(spark, sf, n)
    n = T("nation")
    geo = n.join(T("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("customer_nation"), F.col("r_name").alias("customer_region"))
    sup = T("supplier").join(n.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("supplier_nation")), "s_nationkey").select(F.col("s_suppkey").alias("l_suppkey"), "s_name", "supplier_nation")
    order = T("orders").join(T("customer").join(geo, "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus", "c_name", "customer_nation", "customer_region")
    return T("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").join(order, "l_orderkey").join(T("part").select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey").join(sup, "l_suppkey").drop("l_partkey", "l_suppkey")


@query("SELECT coalesce(geocoding_quality, 'none') AS quality, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS percent FROM canonical_address GROUP BY 1")
def quality_distribution(spark, sf):
    g = table(spark, sf, "canonical_address").groupBy(F.coalesce("geocoding_quality", F.lit("none")).alias("quality")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # over the few groups, not over the rows
    return g.select("quality", "n", F.round(100.0 * F.col("n") / total, 4).alias("percent"))


@query("SELECT id, original_address_id FROM address_mapping WHERE original_address_id IS NOT NULL AND original_address_id NOT IN (SELECT id FROM canonical_address WHERE id IS NOT NULL)")
def fk_orphans(spark, sf):
    return orphans_of(table(spark, sf, "address_mapping"), "original_address_id", table(spark, sf, "canonical_address"), "id").select("id", "original_address_id")


@query("""WITH s AS (SELECT id, county_id, settlement_code, row_number() OVER (PARTITION BY county_id ORDER BY settlement_code, id, loaded_at) AS n FROM settlement WHERE county_id IS NOT NULL),
pick AS (SELECT DISTINCT id FROM s WHERE n <= 5) SELECT d.id, d.tevk, d.settlement_id FROM settlement_individual_electoral_district d WHERE d.settlement_id IN (SELECT id FROM pick)""")
def semi_join_subset(spark, sf):
    s = table(spark, sf, "settlement").where("county_id IS NOT NULL")
    pick = s.withColumn("n", F.row_number().over(Window.partitionBy("county_id").orderBy("settlement_code", "id", "loaded_at"))).where("n <= 5").select(F.col("id").alias("settlement_id")).distinct()
    return table(spark, sf, "settlement_individual_electoral_district").join(pick, "settlement_id", "left_semi").select("id", "tevk", "settlement_id")


@query("SELECT id FROM (SELECT DISTINCT id FROM canonical_address) ORDER BY md5(id), id LIMIT greatest(1, (SELECT count(DISTINCT id) * 5 // 100 FROM canonical_address))")
def md5_sample(spark, sf):
    return deterministic_sample(table(spark, sf, "canonical_address").select("id").distinct(), "id", 5)


_VERIFIED = [c for c in STAGING_COLUMNS if c != "gate_code"]
_TAGS = "(SELECT {}(trim(run_tag)) FROM staging_korzet WHERE trim(run_tag) <> '')"
_ONE = lambda which: f"(SELECT trim(gate_code) AS gate_code, {', '.join(f'max(trim({c})) AS {c}' for c in _VERIFIED)} FROM staging_korzet WHERE trim(run_tag) = {_TAGS.format(which)} AND trim(gate_code) <> '' GROUP BY 1)"
@query(f"""SELECT coalesce(a.gate_code, b.gate_code) AS gate_code, CASE WHEN b.gate_code IS NULL THEN 'only_left' WHEN a.gate_code IS NULL THEN 'only_right' ELSE 'changed' END AS status,
  CASE WHEN a.gate_code IS NOT NULL AND b.gate_code IS NOT NULL THEN concat_ws(',', {', '.join(f"CASE WHEN a.{c} IS DISTINCT FROM b.{c} THEN '{c}' END" for c in _VERIFIED)}) END AS changed
  FROM {_ONE('min')} a FULL JOIN {_ONE('max')} b ON a.gate_code = b.gate_code WHERE a.gate_code IS NULL OR b.gate_code IS NULL OR {' OR '.join(f"a.{c} IS DISTINCT FROM b.{c}" for c in _VERIFIED)}""")
def verify_diff(spark, sf):
    """The first and the last run, field by field."""
    s = staging(spark, sf).withColumn("tag", F.trim("run_tag")).where("tag != '' AND trim(gate_code) != ''")
    first, last = staging(spark, sf).agg(F.min(F.nullif(F.trim("run_tag"), F.lit(""))), F.max(F.nullif(F.trim("run_tag"), F.lit("")))).first()
    one = lambda tag: s.where(F.col("tag") == tag).groupBy(F.trim("gate_code").alias("gate_code")).agg(*(F.max(F.trim(c)).alias(c) for c in _VERIFIED))
    return differences(one(first), one(last), ["gate_code"], _VERIFIED)


_DISTINCT = lambda which, c: f"(SELECT count(DISTINCT trim({c})) FROM staging_korzet WHERE trim(run_tag) = {_TAGS.format(which)} AND trim({c}) <> '')"
@query(" UNION ALL ".join(f"SELECT '{c}' AS table_name, {_DISTINCT('min', c)} AS n_expected, {_DISTINCT('max', c)} AS n_got, abs({_DISTINCT('min', c)} - {_DISTINCT('max', c)}) <= {0 if c == 'gate_code' else 1} AS passed" for c in ("county_code", "settlement_name", "postal_code", "gate_code")))
def verify_row_counts(spark, sf):
    """Tables of the first and the last run by their number of rows: addresses exactly, others with one row's grace."""
    s = staging(spark, sf).withColumn("tag", F.trim("run_tag"))
    first, last = s.agg(F.min(F.nullif("tag", F.lit(""))), F.max(F.nullif("tag", F.lit("")))).first()
    made = lambda tag: {c: s.where((F.col("tag") == tag) & (F.trim(c) != "")).select(F.trim(c)).distinct() for c in ("county_code", "settlement_name", "postal_code", "gate_code")}
    return verify_counts(made(first), made(last), {"gate_code": 0})


_PAIR = """len(string_split_regex(trim(e), '\\s+')) = 2 AND try_cast(string_split_regex(trim(e), '\\s+')[1] AS DOUBLE) BETWEEN -90 AND 90 AND try_cast(string_split_regex(trim(e), '\\s+')[2] AS DOUBLE) BETWEEN -180 AND 180"""
@query(f"""WITH d AS (SELECT DISTINCT id, center, polygon FROM national_individual_electoral_district),
c AS (SELECT id, list_transform(list_filter(string_split(coalesce(polygon, ''), ','), lambda e: {_PAIR}), lambda e: string_split_regex(trim(e), '\\s+')[2] || ' ' || string_split_regex(trim(e), '\\s+')[1]) AS l FROM d)
SELECT d.id, CASE WHEN {_PAIR.replace('e)', 'd.center)')} THEN 'POINT(' || string_split_regex(trim(d.center), '\\s+')[2] || ' ' || string_split_regex(trim(d.center), '\\s+')[1] || ')' END AS point,
 CASE WHEN len(l) >= 3 THEN 'POLYGON((' || array_to_string(CASE WHEN l[1] = l[-1] THEN l ELSE list_append(l, l[1]) END, ', ') || '))' END AS polygon FROM d JOIN c USING (id)""")
def district_wkt(spark, sf):
    d = table(spark, sf, "national_individual_electoral_district").select("id", "center", "polygon").distinct()
    return d.select("id", G.point_wkt("center").alias("point"), G.polygon_wkt("polygon").alias("polygon"))


@query(f"""WITH e AS (SELECT id, i, string_split_regex(trim(string_split(polygon, ',')[i]), '\\s+') AS p FROM (SELECT DISTINCT id, polygon FROM national_individual_electoral_district), generate_series(1, 1000) g(i) WHERE i <= len(string_split(polygon, ','))),
k AS (SELECT id, row_number() OVER (PARTITION BY id ORDER BY i) AS i, count(*) OVER (PARTITION BY id) AS n, CAST(p[1] AS DOUBLE) AS y, CAST(p[2] AS DOUBLE) AS x FROM e WHERE len(p) = 2 AND try_cast(p[1] AS DOUBLE) BETWEEN -90 AND 90 AND try_cast(p[2] AS DOUBLE) BETWEEN -180 AND 180)
SELECT a.id, round(abs(sum(a.x * b.y - b.x * a.y)) / 2, 6) AS area FROM k a JOIN k b ON a.id = b.id AND b.i = a.i % a.n + 1 WHERE a.n >= 3 GROUP BY 1""")
def district_area(spark, sf):
    d = table(spark, sf, "national_individual_electoral_district").select("id", "polygon").distinct()
    return d.select("id", F.round(G.shoelace("polygon"), 6).alias("area")).where("area IS NOT NULL")


_HAV = "2 * 6371000 * asin(least(1, sqrt(pow(sin(radians(b.y - a.y) / 2), 2) + cos(radians(a.y)) * cos(radians(b.y)) * pow(sin(radians(b.x - a.x) / 2), 2))))"
_CENTERS = "(SELECT DISTINCT id, try_cast(string_split_regex(trim(center), '\\s+')[1] AS DOUBLE) AS y, try_cast(string_split_regex(trim(center), '\\s+')[2] AS DOUBLE) AS x FROM national_individual_electoral_district WHERE len(string_split_regex(trim(center), '\\s+')) = 2)"
@query(f"SELECT station, district, round(m, 3) AS metres FROM (SELECT a.id AS station, b.id AS district, {_HAV} AS m, row_number() OVER (PARTITION BY a.id ORDER BY {_HAV}, b.id) AS n FROM (SELECT id, max(latitude) AS y, max(longitude) AS x FROM polling_station WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1) a, {_CENTERS} b WHERE b.y IS NOT NULL) WHERE n = 1")
def haversine_nearest(spark, sf):
    """Nearest district centre of each station."""
    st = table(spark, sf, "polling_station").where("latitude IS NOT NULL AND longitude IS NOT NULL").groupBy("id").agg(F.max("latitude").alias("latitude"), F.max("longitude").alias("longitude"))
    p = F.split(F.trim("center"), r"\s+")
    d = table(spark, sf, "national_individual_electoral_district").where(F.size(p) == 2).select("id", F.get(p, 0).try_cast("double").alias("latitude"), F.get(p, 1).try_cast("double").alias("longitude"))
    return nearest(st, "id", d, "id").select(F.col("left_key").alias("station"), F.col("right_key").alias("district"), F.round("metres", 3).alias("metres"))


@query(f"SELECT DISTINCT station, district FROM (SELECT a.id AS station, b.id AS district FROM (SELECT id, latitude AS y, longitude AS x FROM polling_station WHERE latitude IS NOT NULL AND longitude IS NOT NULL) a JOIN {_CENTERS} b ON {_HAV} <= 10000)")
def radius_join(spark, sf):
    """Stations within 10 km of a district's centre."""
    p = F.split(F.trim("center"), r"\s+")
    d = table(spark, sf, "national_individual_electoral_district").where(F.size(p) == 2).select("id", F.get(p, 0).try_cast("double").alias("latitude"), F.get(p, 1).try_cast("double").alias("longitude"))
    return points_within(table(spark, sf, "polling_station"), "id", d, "id", 10_000).select(F.col("left_key").alias("station"), F.col("right_key").alias("district"))


@query()
def district_overlaps(spark, sf):
    """Districts that lie over each other."""
    return regions_overlap(table(spark, sf, "national_individual_electoral_district"), "id", "polygon")


@query("SELECT event_id, coalesce(CAST(json_extract(props, '$.k') AS VARCHAR), '') AS k, coalesce(json_extract_string(props, '$.missing'), '') AS missing FROM events")
def json_defaults(spark, sf):
    j = F.from_json("props", "k string, missing string")
    return table(spark, sf, "events").select("event_id", F.coalesce(j["k"], F.lit("")).alias("k"), F.coalesce(j["missing"], F.lit("")).alias("missing"))


@query("SELECT a.n_nationkey AS a, b.n_nationkey AS b FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey")
def theta_pairs(spark, sf):
    n = table(spark, sf, "nation")
    return n.select("n_regionkey", F.col("n_nationkey").alias("a")).join(n.select("n_regionkey", F.col("n_nationkey").alias("b")), "n_regionkey").where("a < b").select("a", "b")


@query("SELECT cache_key, latitude, coalesce(latitude BETWEEN 45.7 AND 48.6 AND longitude BETWEEN 16.1 AND 22.9, false) AS in_country FROM geocoding_cache")
def bbox_flag(spark, sf):
    return table(spark, sf, "geocoding_cache").select("cache_key", "latitude", G.in_bounds(F.col("latitude"), F.col("longitude")).alias("in_country"))


_CROWD = lambda digits: f"SELECT {digits} AS digits, round(latitude, {digits}) AS latitude, round(longitude, {digits}) AS longitude, count(DISTINCT cache_key) AS n FROM geocoding_cache WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2, 3 HAVING count(DISTINCT cache_key) > 10"
@query(" UNION ALL ".join(map(_CROWD, (6, 1))))
def density_clusters(spark, sf):
    """Crowded points, and crowded places of about ten kilometres."""
    g = table(spark, sf, "geocoding_cache").where("latitude IS NOT NULL AND longitude IS NOT NULL")
    at = lambda digits: crowded_points(g.select("cache_key", F.round("latitude", digits).alias("latitude"), F.round("longitude", digits).alias("longitude")), "cache_key", "latitude", "longitude")
    return at(6).select(F.lit(6).alias("digits"), "*").unionByName(at(1).select(F.lit(1).alias("digits"), "*"))


@query("SELECT coalesce(source, 'none') AS source, count(*) AS n, round(avg(CASE WHEN quality = 'failed' THEN 0.0 ELSE 1.0 END), 6) AS success_rate, avg(CASE WHEN quality = 'failed' THEN 0.0 ELSE 1.0 END) < 0.95 AS warning FROM geocoding_cache GROUP BY 1")
def success_rate(spark, sf):
    rate = F.avg(F.when(F.col("quality") == "failed", 0.0).otherwise(1.0))
    return table(spark, sf, "geocoding_cache").groupBy(F.coalesce("source", F.lit("none")).alias("source")).agg(F.count(F.lit(1)).alias("n"), F.round(rate, 6).alias("success_rate"), (rate < 0.95).alias("warning"))


@query("SELECT 'canonical_address' AS table_name, count(*) AS total, count(latitude) AS located, count(*) - count(latitude) AS missing FROM canonical_address UNION ALL SELECT 'polling_station', count(*), count(latitude), count(*) - count(latitude) FROM polling_station")
def coverage_status(spark, sf):
    one = lambda n: table(spark, sf, n).agg(F.count(F.lit(1)).alias("total"), F.count("latitude").alias("located"), (F.count(F.lit(1)) - F.count("latitude")).alias("missing")).select(F.lit(n).alias("table_name"), "*")
    return one("canonical_address").unionByName(one("polling_station"))


@query("SELECT canonical_address_id, strftime(max(created_at), '%Y%m%d_%H%M%S') AS run_tag, max(created_at) < TIMESTAMP '2025-10-01 00:00:00' - INTERVAL 24 HOURS AS stale FROM address_mapping GROUP BY 1")
def freshness(spark, sf):
    m = table(spark, sf, "address_mapping").groupBy("canonical_address_id").agg(F.max("created_at").alias("last"))
    return m.select("canonical_address_id", F.date_format("last", "yyyyMMdd_HHmmss").alias("run_tag"), (F.col("last") < F.lit("2025-10-01 00:00:00").cast("timestamp_ntz") - F.expr("INTERVAL 24 HOURS")).alias("stale"))


@query("SELECT user_id, count(*) AS n, count(*) FILTER (event_type = 'click') AS clicks, round(sum(value), 4) AS total FROM events GROUP BY 1 HAVING count(*) > 1")
def conditional_counters(spark, sf):
    e = table(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "click").alias("clicks"), F.round(F.sum("value"), 4).alias("total"))
    return e.where("n > 1")


# Answers of a lookup service, made of cache rows: without an item where the look-up failed.
_ANSWER = "CASE WHEN latitude IS NULL OR longitude IS NULL THEN '{\"items\": []}' ELSE '{\"items\": [{\"resultType\": \"' || CASE osm_type WHEN 'node' THEN 'houseNumber' WHEN 'way' THEN 'street' WHEN 'relation' THEN 'locality' ELSE 'other' END || '\", \"position\": {\"lat\": ' || latitude || ', \"lng\": ' || longitude || '}, \"address\": {\"city\": \"' || coalesce(source, '') || '\"}}]}' END"
@query(f"""SELECT DISTINCT cache_key, CAST(json_extract(j, '$.items[0].position.lat') AS DOUBLE) AS latitude, CAST(json_extract(j, '$.items[0].position.lng') AS DOUBLE) AS longitude, json_extract_string(j, '$.items[0].resultType') AS kind,
  CASE WHEN json_extract(j, '$.items[0]') IS NULL THEN NULL WHEN json_extract_string(j, '$.items[0].resultType') = 'houseNumber' THEN 'exact' WHEN json_extract_string(j, '$.items[0].resultType') = 'street' THEN 'street' WHEN json_extract_string(j, '$.items[0].resultType') = 'locality' THEN 'settlement' WHEN json_extract_string(j, '$.items[0].address.city') IS NOT NULL THEN 'settlement' ELSE 'street' END AS quality
  FROM (SELECT cache_key, {_ANSWER} AS j FROM geocoding_cache)""")
def answer_navigation(spark, sf):
    kind = F.when(F.col("osm_type") == "node", "houseNumber").when(F.col("osm_type") == "way", "street").when(F.col("osm_type") == "relation", "locality").otherwise("other")
    item = F.struct(kind.alias("resultType"), F.struct(F.col("latitude").alias("lat"), F.col("longitude").alias("lng")).alias("position"), F.struct(F.coalesce("source", F.lit("")).alias("city")).alias("address"))
    none = F.lit('{"items": []}')
    j = F.when(F.col("latitude").isNull() | F.col("longitude").isNull(), none).otherwise(F.to_json(F.struct(F.array(item).alias("items"))))
    return table(spark, sf, "geocoding_cache").select("cache_key", answer_place(j).alias("p")).select("cache_key", "p.*").distinct()


@query("SELECT DISTINCT osm_type, CASE WHEN regexp_matches(lower(coalesce(k, '')), 'house|building') THEN 'exact' WHEN regexp_matches(lower(coalesce(k, '')), 'street|road') THEN 'street' WHEN regexp_matches(lower(coalesce(k, '')), 'city|town|village|place') THEN 'settlement' ELSE 'failed' END AS class FROM (SELECT osm_type, CASE osm_type WHEN 'node' THEN 'House' WHEN 'way' THEN 'main road' WHEN 'relation' THEN 'village' END AS k FROM geocoding_cache)")
def quality_by_keywords(spark, sf):
    kind = F.when(F.col("osm_type") == "node", "House").when(F.col("osm_type") == "way", "main road").when(F.col("osm_type") == "relation", "village")
    return table(spark, sf, "geocoding_cache").select("osm_type", quality_by_keyword(kind).alias("class")).distinct()


_CK = "md5(settlement_name || '|' || street_name || '|' || house_number)"
_KEYED_CACHE = f"(SELECT * FROM (SELECT {_CK} AS k, g.latitude, g.longitude, g.quality, row_number() OVER (PARTITION BY {_CK} ORDER BY {_RANK_OF('g.quality')} DESC, g.cache_key, g.created_at) AS n FROM geocoding_cache g JOIN {_ADDR} a USING (canonical_address_id) WHERE {_CK} IS NOT NULL) WHERE n = 1)"
@query(f"SELECT a.canonical_address_id, c.latitude, c.longitude, c.quality, CASE WHEN c.quality <> 'failed' THEN 'cache' END AS source FROM {_ADDR} a LEFT JOIN {_KEYED_CACHE} c ON {_CK} = c.k AND c.quality <> 'failed'")
def cache_join_by_hash(spark, sf):
    """Addresses and the cache joined by the hash of settlement, street and house number; a null in any of them is no key."""
    parts = ("settlement_name", "street_name", "house_number")
    a = addresses(spark, sf).withColumn("k", strict_cache_key(*parts))
    g = table(spark, sf, "geocoding_cache").select("canonical_address_id", "cache_key", "latitude", "longitude", "quality", "created_at").join(a.select("canonical_address_id", "k"), "canonical_address_id").where("k IS NOT NULL")
    c = first_by(g, ["k"], [quality_rank(F.col("quality")).desc(), F.asc("cache_key"), F.asc("created_at")]).select("k", "latitude", "longitude", "quality")
    ids = a.select("canonical_address_id", "k")
    hits, misses = cache_hits(ids, c, "k"), cache_misses(ids.where("k IS NOT NULL"), c, "k").select("canonical_address_id")
    none = ids.where("k IS NULL").select("canonical_address_id").unionByName(misses)
    return hits.select("canonical_address_id", "latitude", "longitude", "quality", "source").unionByName(none, allowMissingColumns=True)


_CORNERS = f"(SELECT DISTINCT id, string_split_regex(trim(e), '\\s+')[1] || ' ' || string_split_regex(trim(e), '\\s+')[2] AS corner FROM (SELECT id, unnest(string_split(coalesce(polygon, ''), ',')) AS e FROM national_individual_electoral_district) WHERE {_PAIR})"
@query(f"SELECT a.id AS a, b.id AS b, count(*) AS corners FROM {_CORNERS} a JOIN {_CORNERS} b ON a.corner = b.corner AND a.id < b.id GROUP BY 1, 2 HAVING count(*) > 1")
def district_neighbours(spark, sf):
    """Districts that share a stretch of border: at least two corners, as written."""
    return G.touching(table(spark, sf, "national_individual_electoral_district"), "id", "polygon")
