"""The whole run as named stages of data frames, with metrics for each."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tessera.functions.keys import md5_16, uuid3
from tessera.functions.textops import house_int, normal_text
from tessera.operators.dedup import dedup_report, survivors_by_score, with_canonical_id
from tessera.operators.geocode import better_wins, cache_hits, cache_misses, interpolate, quality_rank
from tessera.operators.public_spaces import public_spaces
from tessera.operators.serve import canonical_with_lists
from tessera.operators.tables import first_by
from tessera.session import cut

Stage = Callable[[dict[str, DataFrame]], dict[str, DataFrame]]


@dataclass
class Run:
    """Tables made so far and what each stage took."""

    tables: dict[str, DataFrame]
    metrics: list[dict] = field(default_factory=list)

    def stage(self, name: str, make: Stage, count: bool = False, write: Callable[[str, DataFrame], DataFrame] | None = None) -> Run:
        """Add the tables that a stage makes.

        With ``count`` their rows are counted, which computes them. With ``write`` each is written by that function,
        which gives back what is to be read from then on; its rows are counted as they pass, so nothing is computed twice.
        """
        began = time.time()
        made = make(self.tables)
        rows = {}
        for k, df in made.items():
            if write:
                seen = Observation(f"{name}.{k}")
                made[k] = write(k, df.observe(seen, F.count(F.lit(1)).alias("rows")))
                rows[k] = seen.get["rows"]
            elif count:
                rows[k] = df.count()
        self.tables |= made
        self.metrics.append({"stage": name, "seconds": time.time() - began, "rows": rows})
        return self


def entities(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Counties, settlements, postal codes and stations of a staging table."""
    s = t["staging"].select(*(F.trim(c).alias(c) for c in ("county_code", "county_name", "settlement_code", "settlement_name", "postal_code", "oevk_code", "tevk_code", "polling_station_address")))
    return {
        "county": s.where("county_code != ''").groupBy("county_code").agg(F.max("county_name").alias("county_name")).withColumn("id", md5_16("county_code")),
        "settlement": s.where("settlement_code != ''").groupBy("county_code", "settlement_code").agg(F.max("settlement_name").alias("settlement_name")).withColumn("id", md5_16("county_code", "settlement_code")),
        "postal_code": s.where("postal_code NOT IN ('', '0')").select("postal_code").distinct().withColumn("id", md5_16("postal_code")),
        "polling_station": s.where("polling_station_address != ''").select("county_code", "settlement_code", "oevk_code", F.coalesce("tevk_code", F.lit("-")).alias("tevk_code"), "polling_station_address").distinct(),
    }


def resolution(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Canonical addresses, the mapping to them, and the report."""
    keyed = t.get("links")
    keyed = with_canonical_id(t["staging"]) if keyed is None else keyed
    return {"canonical": survivors_by_score(keyed), "mapping": keyed.select("row_id", "canonical_address_id"), "report": dedup_report(keyed)}


def spaces(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    made = public_spaces(t["staging"].withColumn("settlement_id", md5_16(F.trim("county_code"), F.trim("settlement_code"))), "settlement_id", "street_name", "street_type")
    return {f"public_space_{k}": made[k] for k in ("names", "types", "junction")}


def relations(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Links of canonical addresses to stations and postal codes, of postal codes to settlements, and both kinds of districts."""
    links = t["links"]
    county, settlement, name, postal, oevk = (F.trim(c) for c in ("county_code", "settlement_code", "settlement_name", "postal_code", "oevk_code"))
    tevk = F.nullif(F.trim("tevk_code"), F.lit(""))
    codes = t["staging"].where(~postal.isin("", "0")).select(md5_16(postal).alias("postal_code_id"), md5_16(county, settlement).alias("settlement_id")).distinct()
    return {
        "address_station": links.where("polling_station_code IS NOT NULL").select("canonical_address_id", F.trim("polling_station_code").alias("polling_station_code")).distinct(),
        "address_postal_code": links.select("canonical_address_id", postal.alias("postal_code")).where("postal_code != ''").distinct(),
        "postal_code_settlement": codes.withColumn("id", md5_16("postal_code_id", "settlement_id")),
        "settlement_district": t["staging"].select(
            county.alias("county_code"), settlement.alias("settlement_code"), F.coalesce(tevk, F.lit("-")).alias("tevk"),
            F.when(tevk.isNull(), name).otherwise(F.concat(name, F.lit(" "), tevk, F.lit(". TEVK"))).alias("district_name"), md5_16(county, settlement, F.coalesce(tevk, F.lit("-"))).alias("id")).distinct(),
        "national_district": t["staging"].select(county.alias("county_code"), oevk.alias("oevk_code")).where("county_code != '' AND oevk_code != ''").distinct().withColumn("id", md5_16("county_code", "oevk_code")),
    }


def _by_address(earlier: DataFrame) -> DataFrame:
    """The ids of earlier canonical records, with the canonical id that this run gives to their address."""
    return earlier.where("id IS NOT NULL").select("id", md5_16(F.upper(F.trim("county_code")), normal_text("settlement_name"), normal_text("full_address")).alias("canonical_address_id"), "latitude", "longitude", F.coalesce("geocoding_quality", F.lit("failed")).alias("quality"))


def geocoding(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Coordinates of the canonical addresses: what earlier runs held, better cache rows in their place, the rest of a street interpolated.

    ``earlier`` and ``cache`` are laid out as canonical_address and geocoding_cache; their ids are those of earlier
    records, whose addresses give the ids of this run.
    """
    best = lambda df, *more: first_by(df, ["canonical_address_id"], [quality_rank(F.col("quality")).desc(), *map(F.asc, (*more, "latitude", "longitude", "quality"))])
    earlier = cut(_by_address(t["earlier"]))
    ids = earlier.select(F.col("id").alias("canonical_address_id"), F.col("canonical_address_id").alias("now")).distinct()
    cached = t["cache"].select("canonical_address_id", "cache_key", "latitude", "longitude", "quality").join(ids, "canonical_address_id").drop("canonical_address_id").withColumnRenamed("now", "canonical_address_id")
    cached = cut(best(cached.where("latitude IS NOT NULL AND longitude IS NOT NULL"), "cache_key"))
    old = t["canonical"].join(best(earlier).select("canonical_address_id", "latitude", "longitude", "quality"), "canonical_address_id", "left")
    old = old.withColumn("quality", F.coalesce("quality", F.lit("failed"))).withColumn("source", F.when(F.col("latitude").isNotNull(), "earlier"))
    hits = cache_hits(t["canonical"].select("canonical_address_id"), cached, "canonical_address_id")
    merged = cut(better_wins(old, hits, "canonical_address_id", ["latitude", "longitude", "source"]))
    points = merged.select("canonical_address_id", "county_code", "settlement_name", "street_name", house_int("house").alias("number"), "latitude", "longitude", "quality")
    new = interpolate(points, ["county_code", "settlement_name", "street_name"], "number", "latitude", "longitude", "quality", "canonical_address_id")
    j = merged.join(new, "canonical_address_id", "left")
    located = j.select(*(
        {"latitude": F.coalesce("new_latitude", "latitude"), "longitude": F.coalesce("new_longitude", "longitude"), "source": F.coalesce("new_source", "source"), "quality": F.coalesce("new_quality", "quality")}.get(c, F.col(c)).alias(c)
        for c in merged.columns))
    return {"geocoding_hit": hits, "geocoding_miss": cache_misses(t["canonical"].select("canonical_address_id"), cached, "canonical_address_id"), "located": cut(located)}


def export(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Serving tables: canonical addresses with place, lists and exported id, and each original with its canonical address."""
    stations = t["address_station"].withColumnRenamed("polling_station_code", "polling_station_id")
    originals = t["mapping"].withColumnRenamed("row_id", "original_address_id")
    wide = canonical_with_lists(t["located"], stations, originals)
    full = t["canonical"].select("canonical_address_id", "full_address")
    return {"address_export": wide.withColumn("export_id", uuid3("canonical_address_id")), "original_export": t["mapping"].join(full, "canonical_address_id").select("row_id", "canonical_address_id", "full_address")}


def run(staging: DataFrame, count: bool = False) -> Run:
    """Staging to entities, canonical addresses and public spaces; lazily, unless ``count``."""
    return Run({"staging": staging}).stage("entities", entities, count).stage("resolution", resolution, count).stage("spaces", spaces, count)


def whole_run(staging: DataFrame, earlier: DataFrame, cache: DataFrame, count: bool = False) -> Run:
    """Staging, earlier canonical records and their geocoding cache to all derived tables and those to be exported.

    The canonical ids of the rows and the canonical addresses, which most other tables are made of, are written down
    once, and so is what geocoding uses more than once; all else is lazy, unless ``count``.
    """
    kept = ["row_id", "canonical_address_id", "polling_station_code", "postal_code", "county_code", "settlement_name", "street_name", "house", "bldg", "stairs", "full_address", "accessible"]
    links = cut(with_canonical_id(staging).select(*kept))
    made = Run({"staging": staging, "earlier": earlier, "cache": cache, "links": links}).stage("entities", entities, count)
    made.stage("resolution", lambda t: {k: cut(df) if k == "canonical" else df for k, df in resolution(t).items()}, count).stage("spaces", spaces, count)
    return made.stage("relations", relations, count).stage("geocoding", geocoding, count).stage("export", export, count)
