"""Writers of exports: single tables, partitioned tables, chunked files, SQL texts."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.textops import sql_literal
from tessera.operators.export import EXPORTED, as_exported


def write_csv(df: DataFrame, path: str, rows_per_file: int = 0) -> None:
    """A table as CSV with header, in files of at most ``rows_per_file`` rows (0: no bound)."""
    df.write.mode("overwrite").option("header", True).option("maxRecordsPerFile", rows_per_file).csv(path)


def write_by(df: DataFrame, path: str, column: str, rows_per_file: int = 1_000_000, fmt: str = "csv") -> None:
    """A folder for each value of ``column``, in files of at most ``rows_per_file`` rows.

    Rows are rebalanced by value at run time: small values share tasks, and a value with very many rows is spread over as
    many as its size asks for.
    """
    df.hint("rebalance", F.col(column)).write.mode("overwrite").partitionBy(column).option("header", True).option("maxRecordsPerFile", rows_per_file).format(fmt).save(path)


def file_of(run_tag: str, table: str) -> str:
    """Name of a table's export in a run."""
    return f"{run_tag}_{''.join(w.capitalize() for w in table.split('_'))}.csv"


def write_tables(tables: dict[str, DataFrame], folder: str, run_tag: str, other_store: bool = False, rows_per_file: int = 1_000_000) -> dict[str, str]:
    """All tables at hand as CSV, each after those it refers to; with ``other_store`` in the other store's shape. Returns the paths by table."""
    out = {}
    for e in EXPORTED:
        if e.name in tables:
            out[e.name] = f"{folder}/{file_of(run_tag, e.name)}"
            write_csv(as_exported(tables[e.name], e) if other_store else tables[e.name], out[e.name], rows_per_file)
    return out


def write_runs(df: DataFrame, path: str) -> None:
    """Staging rows, one folder for each run, other runs untouched."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_tag").parquet(path)


def insert_statements(df: DataFrame, name: str) -> Column:
    """An INSERT statement for each row."""
    values = [F.when(F.col(c).isNull(), F.lit("NULL")).otherwise(sql_literal(F.col(c).cast("string"))) for c in df.columns]
    return F.concat(F.lit(f"INSERT INTO {name} ({', '.join(df.columns)}) VALUES ("), F.concat_ws(", ", *values), F.lit(");"))


SQL_TYPES = {T.StringType: "TEXT", T.IntegerType: "INTEGER", T.LongType: "BIGINT", T.DoubleType: "DOUBLE PRECISION", T.BooleanType: "BOOLEAN", T.TimestampType: "TIMESTAMPTZ", T.TimestampNTZType: "TIMESTAMP"}


def create_table(schema: T.StructType, name: str, primary_key: str | None = None, refers_to: dict[str, str] | None = None) -> str:
    """DDL text of a table; ``refers_to`` names the table that a column refers to. References are checked when a load is over."""
    lines = [f"  {f.name} {SQL_TYPES.get(type(f.dataType), 'TEXT')}{'' if f.nullable else ' NOT NULL'}" for f in schema]
    if primary_key:
        lines.append(f"  PRIMARY KEY ({primary_key})")
    lines += [f"  FOREIGN KEY ({c}) REFERENCES {t} (id) DEFERRABLE INITIALLY DEFERRED" for c, t in (refers_to or {}).items()]
    return f"CREATE TABLE {name} (\n" + ",\n".join(lines) + "\n);"


def import_script(files: dict[str, list[str]], columns: dict[str, list[str]]) -> str:
    """SQL text that loads exported files in one transaction, tables after those they refer to, references checked at its end."""
    lines = ["BEGIN;", "SET CONSTRAINTS ALL DEFERRED;"]
    for e in EXPORTED:
        lines += [f"\\copy {e.name} ({', '.join(columns[e.name])}) FROM '{f}' WITH (FORMAT csv, HEADER true)" for f in files.get(e.name, [])]
    return "\n".join([*lines, "COMMIT;", *(f"ANALYZE {e.name};" for e in EXPORTED if e.name in files)]) + "\n"


def manifest(tables: dict[str, int], run_tag: str, paths: dict[str, str] | None = None, digests: dict[str, str] | None = None) -> str:
    """JSON text that lists the tables of an export with their row counts, and paths and SHA-256 digests where given; ``latest`` maps plain names to this run's."""
    rows = [{"name": k, "rows": v} | ({"path": paths[k]} if paths and k in paths else {}) | ({"sha256": digests[k]} if digests and k in digests else {}) for k, v in tables.items()]
    latest = {"latest": {file_of("", k).lstrip("_"): file_of(run_tag, k) for k in tables}} if paths else {}
    return json.dumps({"run_tag": run_tag, "tables": rows} | latest, ensure_ascii=False, indent=1)


def table_digest(df: DataFrame) -> str:
    """SHA-256 over a table's rows in any order: rows are hashed, hashes counted by their beginning, and the counts' digest taken."""
    h = F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256)
    parts = df.select(h.alias("h")).groupBy(F.substring("h", 1, 2).alias("p")).agg(F.bit_xor(F.conv(F.substring("h", 3, 15), 16, 10).cast("long")).alias("x"), F.sum(F.conv(F.substring("h", 18, 12), 16, 10).cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n")).collect()  # 256 rows at most
    return hashlib.sha256("\n".join(f"{r['p']} {r['x']} {r['s']} {r['n']}" for r in sorted(parts, key=lambda r: r["p"])).encode()).hexdigest()
