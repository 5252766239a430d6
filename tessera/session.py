"""Session helpers shared by every operator."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings that tests and the bench use."""
    return shipped(
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tessera")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shipped(spark: SparkSession) -> SparkSession:
    """The session, its Python workers supplied with this package, so that they need not have it installed."""
    sc = spark.sparkContext
    if not getattr(sc, "_tessera_shipped", False):
        root = Path(__file__).resolve().parent
        target = os.path.join(sc._temp_dir, f"{root.name}.zip")
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        sc.addPyFile(target)
        sc._tessera_shipped = True
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test data or of a lake laid out alike: one Parquet path per table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: what the cluster names in ``spark.checkpoint.dir``.

    A folder of our own, new for each process, is used only where that setting is missing, which is the case in local tests.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        sc = spark.sparkContext
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if not hasattr(sc, "_tessera_folder"):
            sc._tessera_folder = tempfile.mkdtemp(prefix="tessera-checkpoints-")
            atexit.register(shutil.rmtree, sc._tessera_folder, ignore_errors=True)
        configured = sc._tessera_folder
    return configured


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    """File system and name within it of a path or URI, for tasks that read or write files themselves."""
    return fs.FileSystem.from_uri("/" + path[5:].lstrip("/") if path.startswith("file:") else path)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: write the rows as a table in the shared folder, and go on from that.

    Columns are packed and read back only as far as they are needed, and the optimizer knows the table's size. Every
    call writes a folder of its own; the folders go with the shared folder.
    """
    path = f"{shared_folder(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# White space of any kind, and two invisible signs that come with copied text.
WHITE = "".join(map(chr, [0x20, *range(0x09, 0x0E), *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF]))


def strip(c: Column | str) -> Column:
    """Remove white space of any kind at both ends (plain ``trim`` removes blanks only)."""
    return F.btrim(F.col(c) if isinstance(c, str) else c, F.lit(WHITE))


def blank_to_empty(c: Column | str) -> Column:
    """Stripped text, null as the empty text."""
    return F.coalesce(strip(c), F.lit(""))
