"""Queries of the general training-data operators (problems 1, 2, 3 and 5) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.orphans import Reference, orphans
from tessera.operators.proximity import near_pairs, regions_of
from tessera.operators.rejects import STAGING_COLUMNS, parse_records
from tessera.operators.snapshots import snapshot_changes
from tessera.session import table

NEAR_M = 15.0


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    t = {n: table(spark, sf, n) for n in ("county", "settlement", "settlement_individual_electoral_district", "polling_station", "address_polling_stations")}
    sied = "settlement_individual_electoral_district"
    return orphans([
        Reference("settlement", t["settlement"], "id", "county_id", "loaded_at", t["county"], target_to="deleted_at"),
        Reference(sied, t[sied], "id", "settlement_id", "loaded_at", t["settlement"], target_to="deleted_at"),
        Reference("address_polling_stations", t["address_polling_stations"], "id", "polling_station_id", "created_at", t["polling_station"], target_to="deleted_at"),
    ])


def p1_report(spark: SparkSession, sf: str) -> DataFrame:
    """Orphan rows per table and month."""
    return p1_found(spark, sf).groupBy("table_name", "load_month").agg(F.count(F.lit(1)).alias("orphan_rows"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    staging = table(spark, sf, "staging_korzet")
    columns = [c for c in STAGING_COLUMNS if c != "gate_code"]
    return snapshot_changes(staging, "run_tag", "gate_code", columns, ("loaded_at", "row_id"), with_columns=False)


def p2_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Which columns changed, how often, per run."""
    staging = table(spark, sf, "staging_korzet")
    columns = [c for c in STAGING_COLUMNS if c != "gate_code"]
    changes = snapshot_changes(staging, "run_tag", "gate_code", columns, ("loaded_at", "row_id"))
    return (
        changes.where("change_kind = 'changed'").select("run_tag", F.explode("changed_columns").alias("column_name"))
        .groupBy("run_tag", "column_name").agg(F.count(F.lit(1)).alias("n_changed"))
    )


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    points = table(spark, sf, "geocoding_cache")
    near = near_pairs(points, "cache_key", "latitude", "longitude", NEAR_M)
    inside = regions_of(points, table(spark, sf, "national_individual_electoral_district"), "cache_key", "latitude", "longitude", "id", "polygon")
    return near.select(F.lit("near").alias("pair_kind"), "left_key", "right_key").unionByName(
        inside.select(F.lit("inside").alias("pair_kind"), F.col("point_key").alias("left_key"), F.col("region_id").alias("right_key")))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "raw_korzet").where("line_no > 1")
    return parse_records(raw, with_fields=False).where("reason IS NOT NULL").distinct()


def p5_loaded(spark: SparkSession, sf: str) -> DataFrame:
    """The sound records in the staging columns."""
    raw = table(spark, sf, "raw_korzet").where("line_no > 1")
    return parse_records(raw, keep=("record_id", "file_name", "line_no")).where("reason IS NULL").drop("reason")


def p5_form(spark: SparkSession, sf: str) -> DataFrame:
    """Records that are broken in form: badly quoted, or with the wrong number of columns."""
    raw = table(spark, sf, "raw_korzet").where("line_no > 1")
    return parse_records(raw, with_fields=False).where("reason IN ('quoting', 'column_count')").distinct()


QUERIES = {f.__name__: f for f in (p1_found, p1_report, p2_found, p2_changes, p3_found, p5_found, p5_form, p5_loaded)}

_SPACE = r"'[\s\p{Z}\x{FEFF}\x{200B}]'"
_KEY = lambda c: rf"lower(regexp_replace({c}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g'))"
_FOUND = lambda name, t, key, time, target: f"""
    SELECT '{name}' AS table_name, strftime(r.{time}, '%Y-%m') AS load_month, r.id
    FROM {t} r
    WHERE r.{key} IS NOT NULL AND {_KEY("r." + key)} <> '' AND r.{time} IS NOT NULL AND NOT EXISTS (
        SELECT 1 FROM {target} p WHERE {_KEY("p.id")} = {_KEY("r." + key)}
        AND p.loaded_at <= r.{time} AND (p.deleted_at IS NULL OR p.deleted_at > r.{time}))"""  # noqa: E731
_P1 = "SELECT DISTINCT * FROM (" + " UNION ALL ".join([
    _FOUND("settlement", "settlement", "county_id", "loaded_at", "county"),
    _FOUND("settlement_individual_electoral_district", "settlement_individual_electoral_district", "settlement_id", "loaded_at", "settlement"),
    _FOUND("address_polling_stations", "address_polling_stations", "polling_station_id", "created_at", "polling_station"),
]) + ")"

_TIDY = lambda c: rf"regexp_replace(coalesce({c}, ''), '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
_COLS = [c for c in STAGING_COLUMNS if c != "gate_code"]
_P2_BASE = f"""
WITH tidy AS (SELECT run_tag, {_TIDY("gate_code")} AS gate_code, loaded_at, row_id, {", ".join(f"{_TIDY(c)} AS {c}" for c in _COLS)} FROM staging_korzet),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_tag, gate_code ORDER BY loaded_at DESC, row_id DESC) AS rn FROM tidy WHERE gate_code <> '') WHERE rn = 1),
runs AS (SELECT run_tag, lead(run_tag) OVER (ORDER BY run_tag) AS next_tag FROM (SELECT DISTINCT run_tag FROM staging_korzet)),
old AS (SELECT r.next_tag AS tag, o.* FROM one o JOIN runs r USING (run_tag) WHERE r.next_tag IS NOT NULL),
new AS (SELECT run_tag AS tag, o.* FROM one o WHERE run_tag <> (SELECT min(run_tag) FROM staging_korzet))
"""
_P2_FOUND = _P2_BASE + f"""
SELECT coalesce(n.tag, o.tag) AS run_tag, coalesce(n.gate_code, o.gate_code) AS gate_code,
       CASE WHEN o.tag IS NULL THEN 'added' WHEN n.tag IS NULL THEN 'removed' ELSE 'changed' END AS change_kind
FROM old o FULL JOIN new n ON o.tag = n.tag AND o.gate_code = n.gate_code
WHERE o.tag IS NULL OR n.tag IS NULL OR {" OR ".join(f"o.{c} <> n.{c}" for c in _COLS)}
"""
_P2_CHANGES = _P2_BASE + " UNION ALL ".join(
    f"SELECT n.tag AS run_tag, '{c}' AS column_name, count(*) AS n_changed FROM old o JOIN new n ON o.tag = n.tag AND o.gate_code = n.gate_code WHERE o.{c} <> n.{c} GROUP BY 1"
    for c in _COLS)

_P3 = """
WITH pts AS (SELECT DISTINCT cache_key, latitude AS y, longitude AS x FROM geocoding_cache
             WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AND NOT (latitude = 0 AND longitude = 0)),
near AS (
  SELECT a.cache_key AS left_key, b.cache_key AS right_key FROM pts a JOIN pts b ON b.y BETWEEN a.y - 0.001 AND a.y + 0.001 AND a.cache_key < b.cache_key
  WHERE 2 * 6371000 * asin(least(1, sqrt(pow(sin(radians(b.y - a.y) / 2), 2) + cos(radians(a.y)) * cos(radians(b.y)) * pow(sin(radians(b.x - a.x) / 2), 2)))) <= 15),
parts AS (SELECT id, i, string_split_regex(trim(string_split(polygon, ',')[i]), '\\s+') AS p
          FROM national_individual_electoral_district, generate_series(1, 1000) g(i) WHERE i <= len(string_split(polygon, ','))),
corners AS (SELECT id, row_number() OVER (PARTITION BY id ORDER BY i) AS i, count(*) OVER (PARTITION BY id) AS n, try_cast(p[1] AS DOUBLE) AS y, try_cast(p[2] AS DOUBLE) AS x
            FROM parts WHERE len(p) = 2 AND try_cast(p[1] AS DOUBLE) IS NOT NULL AND try_cast(p[2] AS DOUBLE) IS NOT NULL),
lines AS (SELECT a.id, a.y AS y1, a.x AS x1, b.y AS y2, b.x AS x2 FROM corners a JOIN corners b ON a.id = b.id AND b.i = a.i % a.n + 1 WHERE a.n >= 3 AND a.y <> b.y),
inside AS (
  SELECT p.cache_key AS left_key, l.id AS right_key FROM pts p JOIN lines l
  ON (l.y1 > p.y) <> (l.y2 > p.y) AND p.x < (l.x2 - l.x1) * (p.y - l.y1) / (l.y2 - l.y1) + l.x1
  GROUP BY 1, 2 HAVING count(*) % 2 = 1)
SELECT 'near' AS pair_kind, left_key, right_key FROM near UNION ALL SELECT 'inside', left_key, right_key FROM inside
"""

_FIELD = r'(?:"(?:[^"]|"")*"|[^";]*)'
_P5_FORM = f"""WITH r AS (SELECT record_id, regexp_replace(coalesce(raw_record, ''), $$\\r\\z$$, '') AS t FROM raw_korzet WHERE line_no > 1),
n AS (SELECT *, regexp_full_match(t, $$(?s){_FIELD}(?:;{_FIELD})*$$) AS quoted, regexp_replace(t, $$(?s)"(?:[^"]|"")*"$$, '', 'g') AS bare FROM r)
SELECT DISTINCT record_id, CASE WHEN NOT quoted THEN 'quoting' ELSE 'column_count' END AS reason FROM n WHERE NOT quoted OR length(bare) - length(replace(bare, ';', '')) <> {len(STAGING_COLUMNS) - 1}"""

ORACLE = {
    "p5_form": _P5_FORM,
    "p1_found": _P1,
    "p1_report": f"SELECT table_name, load_month, count(*) AS orphan_rows FROM ({_P1}) GROUP BY 1, 2",
    "p2_found": _P2_FOUND,
    "p2_changes": _P2_CHANGES,
    "p3_found": _P3,
}
