"""Public spaces of settlements: names, types, their junction, and keys on addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.keys import md5_16


def public_spaces(addresses: DataFrame, settlement: str, name: str, kind: str) -> dict[str, DataFrame]:
    """Tables ``names``, ``types``, ``junction`` (``settlement_id``, ids of both, own id) and ``addresses`` with both ids.

    Blank names or types make no entry; addresses keep a null id for them.
    """
    n, k = F.trim(name), F.trim(kind)
    used = addresses.withColumn("name_id", F.when(n != "", md5_16(n))).withColumn("type_id", F.when(k != "", md5_16(k)))
    names = used.where("name_id IS NOT NULL").groupBy(F.col("name_id").alias("id")).agg(F.min(n).alias("name"))
    types = used.where("type_id IS NOT NULL").groupBy(F.col("type_id").alias("id")).agg(F.min(k).alias("name"))
    both = used.where("name_id IS NOT NULL AND type_id IS NOT NULL").select(F.col(settlement).alias("settlement_id"), "name_id", "type_id").distinct()
    return {"names": names, "types": types, "junction": both.withColumn("id", md5_16("settlement_id", "name_id", "type_id")), "addresses": used}
