"""Readers of the source files. Only local or shared paths are read; fetching files is left to the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.rejects import STAGING_COLUMNS

DISTRICT_FIELDS = ("maz", "evk", "centrum", "poligon")


def staging_schema() -> T.StructType:
    """All staging columns as text, so that leading zeros stay."""
    return T.StructType([T.StructField(c, T.StringType()) for c in STAGING_COLUMNS])


def read_staging_csv(spark: SparkSession, path: str, run_tag: str, tolerant: bool = True) -> DataFrame:
    """A delivery in CSV by column position: ``;``, quoted, with header and byte-order mark, 18 fields.

    ``tolerant`` drops rows that do not fit (whatever columns a query reads, hence no pruning in the parser); to keep them with a reason, use ``parse_records``. An empty
    ``tevk_code`` is read as null, other empty fields as empty text.
    """
    df = (
        spark.read.schema(staging_schema()).option("sep", ";").option("header", True).option("enforceSchema", True).option("quote", '"')
        .option("escape", '"').option("encoding", "UTF-8").option("columnPruning", False).option("mode", "DROPMALFORMED" if tolerant else "FAILFAST").csv(path)
    )
    tidy = [F.coalesce(F.trim(F.col(c)), F.lit("")).alias(c) if c != "tevk_code" else F.nullif(F.trim(F.col(c)), F.lit("")).alias(c) for c in STAGING_COLUMNS]
    return df.select(F.lit(run_tag).alias("run_tag"), *tidy)


def read_districts_json(spark: SparkSession, path: str, run_tag: str) -> DataFrame:
    """District rows of a JSON array; missing fields of the two keys are empty, of the geometry null. A missing file gives no rows."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in DISTRICT_FIELDS])
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        rows = spark.createDataFrame([], schema)
    else:
        rows = spark.read.schema(schema).option("multiLine", True).json(path)
    return rows.select(F.coalesce("maz", F.lit("")).alias("maz"), F.coalesce("evk", F.lit("")).alias("evk"), "centrum", "poligon", F.lit(run_tag).alias("run_tag"))


def read_plain_csv(spark: SparkSession, path: str, sep: str = ";", null: str = "") -> DataFrame:
    """A CSV file with header, all columns text; fields that equal ``null``, quoted or not, are null."""
    rows = spark.read.option("sep", sep).option("header", True).option("inferSchema", False).option("nullValue", null).option("emptyValue", null).option("escape", '"').csv(path)
    return rows.select(*(F.nullif(F.col(f"`{c}`"), F.lit(null)).alias(c) for c in rows.columns))


def rows_as_json(df: DataFrame, keep_nulls: bool = True) -> DataFrame:
    """Every row as one JSON object: column ``row``."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": str(not keep_nulls).lower()}).alias("row"))


def read_run(spark: SparkSession, path: str, run_tag: str) -> DataFrame:
    """One run of a staging table that is written by run."""
    return spark.read.parquet(path).where(F.col("run_tag") == run_tag)
