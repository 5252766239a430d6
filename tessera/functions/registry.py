"""Functions that SQL text can call, as temporary SQL functions; their bodies are inlined by the optimizer."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tessera.functions.keys import NAMESPACE


def _hash(*parts: str) -> str:
    """First 16 hex digits of the MD5 of the parts joined by ``|``; null if any part is."""
    return f"substr(md5({" || '|' || ".join(parts)}), 1, 16)"


def _uuid(version: int) -> str:
    """UUID of the text ``x`` in the export name space; null and empty give null."""
    digest = f"{'md5' if version == 3 else 'sha1'}(concat(unhex('{NAMESPACE.hex}'), encode(x, 'UTF-8')))"
    variant = "element_at(array('8','9','a','b','8','9','a','b','8','9','a','b','8','9','a','b'), cast(conv(substr(d, 17, 1), 16, 10) AS INT) + 1)"
    parts = f"substr(d, 1, 8) || '-' || substr(d, 9, 4) || '-{version}' || substr(d, 14, 3) || '-' || {variant} || substr(d, 18, 3) || '-' || substr(d, 21, 12)"
    return f"CASE WHEN x <> '' THEN {parts.replace('(d,', f'({digest},')} END"


_ZEROS = "CASE WHEN ltrim('0', {x}) = '' THEN '0' ELSE ltrim('0', {x}) END"
_SIDE = "transform(split(x, '-'), p -> CASE WHEN p RLIKE '^0*[0-9]+.*' THEN regexp_replace(p, '^0+(?=[0-9])', '') ELSE p END)"
FUNCTIONS = {
    "address_id": ("a STRING, b STRING", "STRING", "substr(md5(concat_ws('|', coalesce(a, ''), coalesce(b, ''))), 1, 16)"),
    "house_int": ("x STRING", "INT", "try_cast(regexp_extract(trim(coalesce(x, '')), '^([0-9]+)', 1) AS INT)"),
    "plain_zeros": ("x STRING", "STRING", f"CASE WHEN x RLIKE '^[0-9]+$' THEN {_ZEROS.format(x='x')} ELSE coalesce(x, '') END"),
    "quality_rank": ("q STRING", "INT", "CASE q WHEN 'exact' THEN 3 WHEN 'street' THEN 2 WHEN 'settlement' THEN 1 ELSE 0 END"),
    # Ids by hash; a null part makes the id null, but for the parts that may be left out.
    "hash_county_id": ("county STRING", "STRING", _hash("county")),
    "hash_settlement_id": ("county STRING, settlement STRING", "STRING", _hash("county", "settlement")),
    "hash_oevk_id": ("county STRING, oevk STRING", "STRING", _hash("county", "oevk")),
    "hash_tevk_id": ("county STRING, settlement STRING, tevk STRING", "STRING", _hash("county", "settlement", "coalesce(tevk, '-')")),
    "hash_postal_code_id": ("postal_code STRING", "STRING", _hash("postal_code")),
    "hash_polling_station_id": ("county STRING, settlement STRING, oevk STRING, tevk STRING, address STRING", "STRING", _hash("county", "settlement", "oevk", "coalesce(tevk, '')", "address")),
    "hash_address_id": (
        "county STRING, settlement STRING, name STRING, kind STRING, house STRING, building STRING, staircase STRING, postal_code STRING", "STRING",
        _hash("county", "settlement", "name", "kind", "house", "coalesce(building, '')", "coalesce(staircase, '')", "postal_code")),
    "hash_postal_code_settlement_id": ("postal_code_id STRING, settlement_id STRING", "STRING", _hash("postal_code_id", "settlement_id")),
    "trim_leading_zeros": ("v STRING", "STRING", f"(SELECT CASE WHEN x IN ('', 'NULL') THEN '' ELSE array_join({_SIDE}, '-') END FROM (SELECT trim(coalesce(v, '')) AS x))"),
    "to_uuid3": ("x STRING", "STRING", _uuid(3)),
    "to_uuid5": ("x STRING", "STRING", _uuid(5)),
    "sql_escape": ("x STRING", "STRING", "replace(x, chr(39), chr(39) || chr(39))"),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Create the functions in the session; returns their names."""
    for name, (arguments, kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {kind} RETURN {body}")
    return list(FUNCTIONS)
