"""Sources, sinks, pipeline, constraints, SQL functions and streaming."""

import hashlib
import json
import time
import uuid

import pytest

from tessera.functions.keys import NAMESPACE
from tessera.functions.registry import register_functions
from tessera.operators.constraints import Constraints, violations
from tessera.operators.rejects import STAGING_COLUMNS
from tessera.operators.tables import last_by
from tessera.operators.dedup import as_json, report_row
from tessera.operators.release import release_checks
from tessera.plans.pipeline import Run, run, whole_run
from tessera.sources.readers import read_districts_json, read_plain_csv, read_run, read_staging_csv, rows_as_json
from tessera.sources.writers import create_table, import_script, insert_statements, manifest, table_digest, write_by, write_csv, write_runs, write_tables
from tessera.streaming.incremental import bucket_paths, deliveries, upsert_stream, windowed_counts

HEADER = "﻿" + ";".join(f'"c{i}"' for i in range(17)) + ";"
LINE = '"01";"Budapest";"01";"001";"Budapest I";"{tevk}";"001";"Úri utca 38. (Önkormányzat)";"N";"I";"1014";"Anna";"utca";"{house}";"";"";"{gate}";'


@pytest.fixture
def csv(tmp_path):
    p = tmp_path / "k.csv"
    p.write_text("\n".join([HEADER, LINE.format(tevk="01", house="000001", gate="1"), LINE.format(tevk="", house="000002/B", gate="2"), '"only";"three";', LINE.format(tevk="01", house="000001", gate="3")]), encoding="utf-8")
    return str(p)


def test_staging_csv(spark, csv, tmp_path):
    df = read_staging_csv(spark, csv, "20250702")
    got = {r.gate_code: r for r in df.collect()}
    assert {k for k in got if k} == {"1", "2", "3"} and got["2"].tevk_code is None and got["1"].house_number == "000001" and got["1"].building == ""
    assert df.columns == ["run_tag", *STAGING_COLUMNS]
    write_runs(df, str(tmp_path / "runs"))
    write_runs(df.limit(1).selectExpr("'x' AS run_tag", *STAGING_COLUMNS), str(tmp_path / "runs"))
    assert read_run(spark, str(tmp_path / "runs"), "x").count() == 1


def test_districts_json(spark, tmp_path):
    p = tmp_path / "d.json"
    p.write_text(json.dumps([{"maz": "01", "evk": "02", "centrum": "47 19"}, {"poligon": "1 2,3 4,5 6"}]))
    got = sorted((r.maz, r.evk, r.centrum or "", r.poligon or "") for r in read_districts_json(spark, str(p), "t").collect())
    assert got == [("", "", "", "1 2,3 4,5 6"), ("01", "02", "47 19", "")]
    assert read_districts_json(spark, str(tmp_path / "none.json"), "t").count() == 0


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("a'b", 1), (None, 2), ("c", 3)], "name string, n int")
    write_csv(df, str(tmp_path / "c"), rows_per_file=1)
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 3
    write_by(df.na.fill("x"), str(tmp_path / "b"), "name")
    assert sorted((r.name, r.n) for r in spark.read.option("header", True).csv(str(tmp_path / "b")).collect()) == [("a'b", "1"), ("c", "3"), ("x", "2")]
    hot = spark.range(5000).selectExpr("IF(id < 4000, 'hot', 'k' || id % 7) AS name", "id")
    write_by(hot, str(tmp_path / "h"), "name", rows_per_file=500)
    assert len([p for p in (tmp_path / "h" / "name=hot").iterdir() if p.suffix == ".csv"]) >= 8 and spark.read.option("header", True).csv(str(tmp_path / "h")).count() == 5000
    assert sorted(r[0] for r in df.select(insert_statements(df, "t")).collect())[1] == "INSERT INTO t (name, n) VALUES ('c', '3');"
    assert create_table(df.schema, "t", "n") == "CREATE TABLE t (\n  name TEXT,\n  n INTEGER,\n  PRIMARY KEY (n)\n);"
    assert json.loads(manifest({"t": 3}, "r"))["tables"] == [{"name": "t", "rows": 3}]
    told = json.loads(manifest({"postal_code": 3}, "r", {"postal_code": "p"}, {"postal_code": "d"}))
    assert told["tables"] == [{"name": "postal_code", "rows": 3, "path": "p", "sha256": "d"}] and told["latest"] == {"PostalCode.csv": "r_PostalCode.csv"}
    assert table_digest(df) == table_digest(df.repartition(3)) != table_digest(df.union(df.limit(1))) and len(table_digest(df.limit(0))) == 64


def test_export_of_tables(spark, tmp_path):
    tables = {
        "settlement": spark.createDataFrame([("s1", "001", "Kisfalu", "c1", None)], "ID string, SettlementCode string, SettlementName string, County_ID string, CreatedAt timestamp"),
        "county": spark.createDataFrame([("c1", "01", "Megye")], "id string, county_code string, county_name string"),
    }
    tables["settlement"] = tables["settlement"].toDF("id", "settlement_code", "settlement_name", "county_id", "loaded_at")
    paths = write_tables(tables, str(tmp_path), "r1", other_store=True)
    assert list(paths) == ["county", "settlement"] and paths["settlement"].endswith("r1_Settlement.csv")
    got = spark.read.option("header", True).csv(paths["settlement"])
    assert got.columns == ["id", "code", "name", "county_id"] and got.first().county_id == spark.read.option("header", True).csv(paths["county"]).first().id
    script = import_script({"settlement": ["b.csv"], "county": ["a.csv"]}, {"settlement": ["id", "code"], "county": ["id"]})
    assert script.index("copy county (id) FROM 'a.csv'") < script.index("copy settlement (id, code) FROM 'b.csv'") and script.startswith("BEGIN;\nSET CONSTRAINTS ALL DEFERRED;")
    assert "FOREIGN KEY (county_id) REFERENCES county (id) DEFERRABLE INITIALLY DEFERRED" in create_table(got.schema, "settlement", "id", {"county_id": "county"})
    now = int(time.time() * 1000)
    assert {c: s for c, s, _ in release_checks(spark, paths, now, tables=tables)} == dict.fromkeys(("file_existence", "file_sizes", "headers", "age", "references"), "passed")
    bad = release_checks(spark, paths | {"gone": str(tmp_path / "gone")}, now + 10**9, {"county": 10**6}, tables=tables | {"county": tables["county"].limit(0)})
    assert [(c, s) for c, s, _ in bad] == [("file_existence", "failed"), ("file_sizes", "failed"), ("headers", "passed"), ("age", "failed"), ("references", "failed")]


def test_plain_csv_and_rows_as_json(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a;b\n"";1\nx;\n')
    df = read_plain_csv(spark, str(tmp_path / "x.csv"))
    assert [tuple(r) for r in df.collect()] == [(None, "1"), ("x", None)]
    assert [r.row for r in rows_as_json(df).collect()] == ['{"a":null,"b":"1"}', '{"a":"x","b":null}']


def test_report(spark):
    one = lambda total, canonical: spark.createDataFrame([(total, canonical, total - canonical, 0.0)], "total_addresses long, canonical_addresses long, duplicates long, duplicate_rate double")
    got = json.loads(as_json(report_row(one(5, 3), "r1", 12)).first().json)
    assert got.pop("created_at")[10] == "T" and got == {"id": hashlib.md5(b"r1").hexdigest()[:16], "run_id": "r1", "total_addresses": 5, "duplicates_found": 2, "canonical_addresses_created": 3, "processing_time_ms": 12, "status": "completed"}
    assert report_row(one(5, 0), "r", 1).first().status == "partial" and report_row(one(5, 0), "r", 1, "e").first().status == "failed"


def test_metrics_while_writing(spark, tmp_path):
    def write(name, df):
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    made = Run({}).stage("one", lambda t: {"a": spark.range(7), "b": spark.range(3)}, write=write)
    assert made.metrics[0]["rows"] == {"a": 7, "b": 3} and made.tables["a"].count() == 7


def test_pipeline(spark, csv):
    from pyspark.sql import functions as F

    staging = read_staging_csv(spark, csv, "1").where("gate_code IS NOT NULL").withColumn("row_id", F.col("gate_code").cast("long"))
    made = run(staging, count=True)
    assert [m["stage"] for m in made.metrics] == ["entities", "resolution", "spaces"]
    assert made.metrics[0]["rows"]["county"] == 1 and made.metrics[1]["rows"] == {"canonical": 2, "mapping": 3, "report": 1}
    assert made.tables["report"].first().duplicates == 1
    assert run(staging.limit(0)).tables["report"].first().duplicate_rate == 0.0


def test_whole_run(spark):
    columns = "county_code county_name settlement_code settlement_name oevk_code tevk_code polling_station_address polling_station_code postal_code street_name street_type house_number building staircase accessible".split()
    row = lambda n, station, postal="1000": (n, "01", "Megye", "001", "Kisfalu", "01", None, "Iskola", station, postal, "Fő", "utca", str(n), None, None, "I")
    staging = spark.createDataFrame([row(1, "1"), row(3, "1"), row(5, "2", "0"), row(7, None)], "row_id long, " + ", ".join(f"{c} string" for c in columns))
    held = [("a", 1, 10.0, "exact"), ("b", 3, 50.0, "street"), ("c", 5, None, None), ("d", 7, None, "failed"), ("e", 9, 9.0, "exact")]
    earlier = spark.createDataFrame([(i, "01", "KISFALU", f"Fő  utca {n}.", x, x, q) for i, n, x, q in held], "id string, county_code string, settlement_name string, full_address string, latitude double, longitude double, geocoding_quality string")
    cache = spark.createDataFrame([("k1", "a", 99.0, 99.0, "street"), ("k2", "c", 14.0, 14.0, "exact"), ("k3", "c", None, None, "exact"), ("k4", "d", 1.0, 1.0, "failed"), ("k5", "gone", 1.0, 1.0, "exact")], "cache_key string, canonical_address_id string, latitude double, longitude double, quality string")
    made = whole_run(staging, earlier, cache, count=True)
    assert [m["stage"] for m in made.metrics] == ["entities", "resolution", "spaces", "relations", "geocoding", "export"]
    rows = {k: n for m in made.metrics for k, n in m["rows"].items()}
    assert {k: rows[k] for k in ("address_station", "address_postal_code", "postal_code_settlement", "settlement_district", "national_district")} == {"address_station": 3, "address_postal_code": 4, "postal_code_settlement": 1, "settlement_district": 1, "national_district": 1}
    assert {k: rows[k] for k in ("geocoding_hit", "geocoding_miss", "located", "address_export", "original_export")} == {"geocoding_hit": 2, "geocoding_miss": 2, "located": 4, "address_export": 4, "original_export": 4}
    got = {r.house: (r.latitude, r.quality, r.source, r.station_ids, r.n_originals) for r in made.tables["address_export"].collect()}
    assert got == {"1": (10.0, "exact", "earlier", "1", 1), "3": (12.0, "interpolated", "interpolated (1-5)", "1", 1), "5": (14.0, "exact", "cache", "2", 1), "7": (None, "failed", None, None, 1)}


def test_constraints(spark):
    t = {"a": spark.createDataFrame([("1", "x"), ("1", "y"), (None, None)], "id string, ref string"), "b": spark.createDataFrame([("x",)], "id string")}
    got = {r.constraint_name: r.n for r in violations(t, {"a": Constraints(("id",), (("id",),), (("ref", "b", "id"),))}).collect()}
    assert got == {"not null id": 1, "unique id": 1, "ref references b.id": 1}


def test_sql_functions(spark):
    register_functions(spark)
    assert tuple(spark.sql("SELECT address_id('01', '001'), house_int(' 10/A'), plain_zeros('0005'), plain_zeros('000'), quality_rank('street'), quality_rank(NULL)").first()) == ("372a08bfcee6fb4d", 10, "5", "0", 2, 0)
    got = spark.sql("SELECT hash_settlement_id('01', '001'), hash_settlement_id('01', NULL), hash_tevk_id('01', '001', NULL), hash_county_id('01'), trim_leading_zeros('000001-00005/D'), to_uuid3('x'), to_uuid5('x'), to_uuid5(''), sql_escape('a''b')").first()
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()[:16]
    assert tuple(got) == ("372a08bfcee6fb4d", None, md5("01|001|-"), "96a3be3cf272e017", "1-5/D", str(uuid.uuid3(NAMESPACE, "x")), str(uuid.uuid5(NAMESPACE, "x")), None, "a''b")


def test_upsert_stream(spark, tmp_path):
    src, schema = tmp_path / "in", "k string, at int, v string"
    for i, rows in enumerate([[("a", 1, "x"), ("b", 1, "x")], [("a", 2, "y"), ("c", 1, "z"), ("b", 0, "old")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(src / str(i)))
    stream = deliveries(spark, str(src / "*"), spark.createDataFrame([], schema).schema, files_per_batch=1)
    seen = []
    q = upsert_stream(stream, ["k"], ["at"], str(tmp_path / "t"), str(tmp_path / "cp"), lambda df, n: seen.append({(r.k, r.v) for r in df.collect()}), buckets=16)
    q.awaitTermination(120)
    assert seen[-1] == {("a", "y"), ("b", "x"), ("c", "z")} and len(seen) == 2
    # The second batch wrote the buckets of its keys only.
    assert {r.k for r in spark.read.parquet(str(tmp_path / "t" / "version=1")).collect()} >= {"a", "b", "c"} and len(bucket_paths(spark, str(tmp_path / "t"), 1)) == len(list((tmp_path / "t" / "version=0").glob("bucket=*")))


def test_windowed_counts(spark, tmp_path):
    spark.sql("SELECT TIMESTAMP '2025-01-01 10:00:00' AS ts, 'a' AS g UNION ALL SELECT TIMESTAMP '2025-01-01 11:00:00', 'a'").coalesce(1).write.parquet(str(tmp_path / "e"))
    stream = deliveries(spark, str(tmp_path / "e"), spark.read.parquet(str(tmp_path / "e")).schema)
    q = windowed_counts(stream, "ts", "g").writeStream.outputMode("complete").format("memory").queryName("counted").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert [r.n for r in spark.table("counted").collect()] == [2]


def test_last_by_is_total(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y")], "k string, o int, v string")
    assert [tuple(r) for r in last_by(df, ["k"], ["o"]).collect()] == [("a", 1, "y")]
