"""Checks of an export before it is given out: files, headers, age, references."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.operators.export import EXPORTED
from tessera.operators.tables import orphans_of


def _files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, bytes, time of change in milliseconds) of a file, or of the data files in a folder."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return [(s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p) if not s.getPath().getName().startswith(("_", "."))]


def release_checks(spark: SparkSession, paths: dict[str, str], now_ms: int, least_bytes: dict[str, int] | None = None, hours: int = 24, tables: dict[str, DataFrame] | None = None) -> list[tuple[str, str, str]]:
    """(check, ``passed`` or ``failed``, message) for exported CSV tables by name.

    Files exist; they are as large as asked; every table has a header; none is older than ``hours``; and, with ``tables``,
    every ``*_id`` column that names an exported table refers to rows that are there.
    """
    files = {n: _files(spark, p) for n, p in paths.items()}
    out = []

    def tell(check: str, bad: list[str]) -> None:
        out.append((check, "failed" if bad else "passed", ", ".join(bad)))

    tell("file_existence", [n for n, f in files.items() if not f])
    tell("file_sizes", [n for n, f in files.items() if f and sum(size for _, size, _ in f) < (least_bytes or {}).get(n, 1)])
    there = [n for n, f in files.items() if f]
    tell("headers", [n for n in there if not (first := spark.read.text(paths[n]).first()) or not first[0].strip()])
    tell("age", [n for n in there if any(now_ms - t > hours * 3_600_000 for _, _, t in files[n])])
    if tables is not None:
        lost = []
        for e in EXPORTED:
            for other in e.refers_to:
                if e.name in tables and other in tables and f"{other}_id" in tables[e.name].columns and not orphans_of(tables[e.name], f"{other}_id", tables[other], "id").isEmpty():
                    lost.append(f"{e.name}.{other}_id")
        tell("references", lost)
    return out
