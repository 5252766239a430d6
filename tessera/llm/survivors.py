"""Best representative of each duplicate group, field by field in a single aggregation.

Every attribute's survivor is the maximum of a composite (has a value, trust of the source, time, number
of attributes with a value, id, value). The record behind no other, if there is one, wins every attribute
that the group has a value for, being the most trusted, the latest and the most complete of all; so it is
read from the winners of the fields. All of it combines before the shuffle, so large groups are cheap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import strip

# Texts that only say that the value is not known.
UNKNOWN = ["", "-", "--", "–", "?", "??", "???", ".", "n/a", "na", "n.a.", "null", "none", "nan", "nincs", "nincs adat", "nincs megadva", "ismeretlen", "nem ismert", "unknown", "unk", "x"]
ATTRIBUTES = ("accessibility_flag", "building", "staircase", "pir_code")
# The other value columns of canonical_address; they do not count towards a whole record.
DESCRIPTION = ("county_code", "settlement_name", "street_name", "house_number", "full_address", "record_source")


def known(c: Column) -> Column:
    """The stripped text, or null where it says nothing."""
    s = strip(c.cast("string"))
    return F.when(~F.lower(s).isin(UNKNOWN), s)


def survivors(records: DataFrame, mapping: DataFrame, trust: DataFrame, attributes: tuple[str, ...] = ATTRIBUTES, description: tuple[str, ...] = (), quality: str | None = None) -> DataFrame:
    """One surviving record for each group that holds at least two different records.

    Result: ``canonical_address_id``, ``n_records``, one column for each attribute, ``latitude``,
    ``longitude``, ``latest``, and ``whole_record_id``: the record behind no other (a value in every
    attribute that any of the group has, coordinates together counting as one; the latest time; the
    highest trust), if exactly one is. A value that only says it is not known is none; a source that is
    not listed, or null, ranks below all listed ones; a missing time is the earliest; NaN is no
    coordinate. Values equal in trust and time are taken from the record that is more complete, then from the
    greater id, so that they come from one record where they can. Repeated records and mappings count once;
    mappings with a null id, or to records that are not there, are left out, so empty tables give no
    rows. Other columns, whatever their names, are not read.

    The columns of ``description`` get survivors alike, but have no say in which record is whole; ties go to the
    greater id. ``quality`` names the column that tells how good the coordinates are; it comes with the coordinates that
    survive, and only where the group has none from the most trusted, latest record that tells it.
    """
    pairs = mapping.select(F.col("canonical_address_id").alias("g"), F.col("original_address_id").alias("id")).where("g IS NOT NULL AND id IS NOT NULL").distinct()
    ranks = trust.groupBy("record_source").agg(F.max("trust_rank").cast("int").alias("rank"))
    point = F.when(F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & ~F.isnan("latitude") & ~F.isnan("longitude"), F.struct("latitude", "longitude"))
    values = {a: known(F.col(a)) for a in attributes} | {"point": point}
    texts = {a: known(F.col(a)) for a in (*description, *([quality] if quality else []))}
    r = records.select("id", "record_source", F.coalesce(F.unix_micros(F.col("updated_at").cast("timestamp")), F.lit(-(2**62))).alias("time"), *(v.alias(f"v_{a}") for a, v in (values | texts).items())).where("id IS NOT NULL").distinct()
    r = r.join(F.broadcast(ranks), "record_source", "left").withColumn("rank", F.coalesce("rank", F.lit(-(2**31))))  # one row for each source
    names = list(values)
    has = [F.col(f"v_{a}").isNotNull() for a in names]
    r = r.withColumn("mask", sum((F.when(h, F.lit(1 << i)).otherwise(F.lit(0)) for i, h in enumerate(has)), F.lit(0)))
    joined = pairs.join(r, "id")
    joined = joined.withColumn("filled", F.bit_count("mask"))
    field = lambda a: F.struct(F.col(f"v_{a}").isNotNull().alias("present"), "rank", "time", "filled", "id", F.col(f"v_{a}").alias("value"))
    more = [F.max(field(a)).alias(f"b_{a}") for a in description]
    if quality:
        pointed = F.col("v_point").isNotNull()
        more.append(F.max(F.struct(pointed.alias("pointed"), (pointed | F.col(f"v_{quality}").isNotNull()).alias("present"), "rank", "time", "filled", "id", F.col(f"v_{quality}").alias("value"))).alias(f"b_{quality}"))
    grouped = joined.groupBy("g").agg(
        F.min("id").alias("low"), F.max("id").alias("high"), F.count(F.lit(1)).alias("n_rows"),
        F.bit_or("mask").alias("any_mask"), F.max("rank").alias("top_rank"), F.max("time").alias("top_time"),
        # The same order with the smallest id last tells whether there is a second record like the winner.
        F.min(F.struct((-F.col("filled")).alias("filled"), (-F.col("rank").cast("long")).alias("rank"), (-F.col("time")).alias("time"), "id")).alias("other"),
        *(F.max(field(a)).alias(f"b_{a}") for a in names),
        *more,
    ).where("low != high")
    # Attributes that none has a value for are won by the foremost record as well, by the rest of the order.
    winners = [F.col(f"b_{a}") for a in names]
    one = winners[0]
    whole = F.col("other.id") == one["id"]
    for w in winners:
        whole = whole & (w["id"] == one["id"]) & (w["rank"] == F.col("top_rank")) & (w["time"] == F.col("top_time")) & (w["filled"] == F.bit_count("any_mask"))
    return grouped.select(
        F.col("g").alias("canonical_address_id"), F.col("n_rows").alias("n_records"),
        *(F.col(f"b_{a}.value").alias(a) for a in (*attributes, *texts)),
        F.col("b_point.value.latitude").alias("latitude"), F.col("b_point.value.longitude").alias("longitude"),
        F.when(F.col("top_time") > -(2**62), F.timestamp_micros("top_time")).alias("latest"),
        F.when(whole, one["id"]).alias("whole_record_id"),
    )
