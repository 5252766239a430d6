"""Incremental processing of arriving deliveries with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.tables import last_by


def deliveries(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_batch: int = 100) -> DataFrame:
    """A stream of the files that arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(fmt).load(path)


def bucket_paths(spark: SparkSession, target: str, before: int | None = None) -> dict[int, str]:
    """The newest folder of every key bucket of a target, of versions before ``before``."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(f"{target}/version=*/bucket=*")
    found: dict[int, tuple[int, str]] = {}
    for status in root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(root) or []:
        path = status.getPath().toString()
        version, bucket = (int(x.split("=")[1]) for x in path.rsplit("/", 2)[1:])
        if (before is None or version < before) and version >= found.get(bucket, (-1, ""))[0]:
            found[bucket] = (version, path)
    return {b: p for b, (_, p) in found.items()}


def current_table(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """The rows that an upserted target holds now."""
    paths = bucket_paths(spark, target)
    return spark.read.schema(schema).parquet(*paths.values()) if paths else spark.createDataFrame([], schema)


def upsert_stream(stream: DataFrame, keys: list[str], order: list[str], target: str, checkpoint: str, then: Callable[[DataFrame, int], None] | None = None, buckets: int = 256) -> StreamingQuery:
    """Keep the last row for each key in a Parquet table that is divided by the keys' hash.

    A batch reads and writes only the buckets that its keys are in: each in a new folder, named after the batch, that
    takes the older one's place. A batch that is repeated after a failure reads what was there before it and writes the
    same again. ``then`` is called with the table as it is after the batch. The number of buckets stays with a target.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        touched = [r[0] for r in batch.select(bucket).distinct().collect()]  # one number for each bucket at most
        held = [p for b, p in bucket_paths(spark, target, number).items() if b in touched]
        rows = spark.read.schema(batch.schema).parquet(*held).unionByName(batch) if held else batch
        last_by(rows, keys, order).withColumn("bucket", bucket).write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/version={number}")
        batch.unpersist()
        if then:
            then(current_table(spark, target, batch.schema), number)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, time: str, group: str, width: str = "1 day", late: str = "7 days") -> DataFrame:
    """Rows for each time window and group, counted until they are later than ``late``."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), group).agg(F.count(F.lit(1)).alias("n"))
