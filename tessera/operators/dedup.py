"""Entity resolution by a normalised key: survivors, kept relations, report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.keys import md5_16
from tessera.functions.textops import clean_house_number, clean_unit, normal_text, structure_score, with_full_address


def with_canonical_id(df: DataFrame) -> DataFrame:
    """Adds the cleaned fields (``house``, ``bldg``, ``stairs``), the formatted address and its ``canonical_address_id``."""
    tidy = df.withColumn("house", clean_house_number("house_number")).withColumn("bldg", clean_unit("building")).withColumn("stairs", clean_unit("staircase"))
    tidy = with_full_address(tidy, "street_name", "street_type", "house", "bldg", "stairs")
    return tidy.withColumn("canonical_address_id", md5_16(F.upper(F.trim("county_code")), normal_text("settlement_name"), normal_text("full_address")))


def survivors_by_score(keyed: DataFrame, row_id: str = "row_id") -> DataFrame:
    """One row for each canonical id: the best structured, the first of equals; the accessibility flag of any."""
    score = structure_score("house", "bldg", "stairs")
    kept = ["county_code", "settlement_name", "street_name", "house", "bldg", "stairs", "full_address"]
    best = keyed.groupBy("canonical_address_id").agg(
        F.max(F.struct(score.alias("score"), (-F.col(row_id)).alias("first"), *kept)).alias("r"),
        F.max(F.when(F.trim("accessible") == "I", 1).otherwise(0)).alias("accessibility_flag"),
    )
    return best.select("canonical_address_id", *(F.col(f"r.{c}").alias(c) for c in kept), "accessibility_flag")


def dedup_report(keyed: DataFrame) -> DataFrame:
    """Totals of a run in one row; the rate is 0 for an empty table."""
    r = keyed.agg(F.count(F.lit(1)).alias("total_addresses"), F.count_distinct("canonical_address_id").alias("canonical_addresses"))
    dup = F.col("total_addresses") - F.col("canonical_addresses")
    return r.withColumn("duplicates", dup).withColumn("duplicate_rate", F.when(F.col("total_addresses") > 0, F.round(dup / F.col("total_addresses"), 6)).otherwise(F.lit(0.0)))


def report_row(report: DataFrame, run_id: str, milliseconds: int, error: str | None = None) -> DataFrame:
    """The report with its id, run, time and status: ``completed``, ``failed`` with an error, ``partial`` without canonical addresses for rows there are."""
    status = F.when(F.lit(error is not None), "failed").when((F.col("total_addresses") > 0) & (F.col("canonical_addresses") == 0), "partial").otherwise("completed")
    return report.select(
        md5_16(F.lit(run_id)).alias("id"), F.lit(run_id).alias("run_id"), "total_addresses", F.col("duplicates").alias("duplicates_found"), F.col("canonical_addresses").alias("canonical_addresses_created"),
        F.lit(milliseconds).cast("long").alias("processing_time_ms"), status.alias("status"), F.lit(error).cast("string").alias("error_message"), F.current_timestamp().cast("timestamp_ntz").alias("created_at"),
    )


def as_json(df: DataFrame) -> DataFrame:
    """Every row as JSON text without its nulls, times in ISO form: column ``json``."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "true", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}).alias("json"))
