"""Serving tables: foreign keys resolved, lists gathered, wide views, canonical exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.keys import uuid3
from tessera.functions.textops import export_score
from tessera.operators.tables import distinct_list


def resolved_keys(links: DataFrame, group: str, keys: list[str]) -> DataFrame:
    """The smallest value of every key for each group, in one aggregation; groups that lack any of them are left out."""
    r = links.groupBy(group).agg(*(F.min(k).alias(k) for k in keys))
    return r.where(" AND ".join(f"{k} IS NOT NULL" for k in keys))


def canonical_with_lists(canonical: DataFrame, stations: DataFrame, originals: DataFrame) -> DataFrame:
    """Canonical rows with sorted lists and counts of their stations and originals; each side is gathered before it is joined."""
    s = stations.groupBy("canonical_address_id").agg(distinct_list(F.col("polling_station_id")).alias("station_ids"), F.count_distinct("polling_station_id").alias("n_stations"))
    o = originals.groupBy("canonical_address_id").agg(F.count_distinct("original_address_id").alias("n_originals"))
    j = canonical.join(s, "canonical_address_id", "left").join(o, "canonical_address_id", "left")
    return j.withColumn("n_stations", F.coalesce("n_stations", F.lit(0))).withColumn("n_originals", F.coalesce("n_originals", F.lit(0)))


def canonical_export(mapping: DataFrame, details: DataFrame) -> DataFrame:
    """One row for each group: the best written of its records, how many there are, and its exported identifier.

    ``details``: ``id`` and the columns house_number, building, staircase, full_address. The best has the highest
    export score, of equals the smallest id; groups without any record have null details and the nil identifier.
    """
    d = details.groupBy("id").agg(F.max(F.struct("full_address", "house_number", "building", "staircase")).alias("d")).select("id", "d.*")
    pairs = mapping.select("canonical_address_id", F.col("original_address_id").alias("id")).distinct()
    j = pairs.join(d, "id", "left").withColumn("score", F.when(F.col("full_address").isNotNull(), export_score("house_number", "building", "staircase")))
    g = j.groupBy("canonical_address_id").agg(
        F.count(F.lit(1)).alias("n_originals"),
        F.min(F.when(F.col("score").isNotNull(), F.struct((-F.col("score")).alias("s"), "id", "full_address"))).alias("best"),
    )
    nil = F.lit("00000000-0000-0000-0000-000000000000")
    return g.select("canonical_address_id", "n_originals", F.col("best.id").alias("best_id"), F.col("best.full_address").alias("full_address"), F.coalesce(uuid3("best.id"), nil).alias("export_id"))
