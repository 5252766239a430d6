"""Queries of the text and record operators (problems 4, 6, 7, 8 and 9) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.addresses import address_pairs
from tessera.llm.leaks import leaks
from tessera.llm.packing import pack_documents
from tessera.llm.splitting import split_documents
from tessera.llm.survivors import DESCRIPTION, UNKNOWN, survivors
from tessera.session import table

CAPACITY, LIMIT, OVERLAP = 2048, 512, 64


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return address_pairs(*(table(spark, sf, n) for n in ("staging_korzet", "canonical_address", "address_mapping", "polling_station")))


def p6_survivors(spark: SparkSession, sf: str) -> DataFrame:
    """One surviving record per group, put together field by field."""
    return survivors(table(spark, sf, "canonical_address"), table(spark, sf, "address_mapping"), table(spark, sf, "source_trust"))


def p6_records(spark: SparkSession, sf: str) -> DataFrame:
    """The surviving record of each group with all value columns of canonical_address."""
    return survivors(table(spark, sf, "canonical_address"), table(spark, sf, "address_mapping"), table(spark, sf, "source_trust"), description=DESCRIPTION, quality="geocoding_quality")


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return p6_survivors(spark, sf).where("whole_record_id IS NOT NULL").select("canonical_address_id", F.col("whole_record_id").alias("original_address_id"))


def p7_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Place of every document, or piece of one, in a training sequence."""
    return pack_documents(table(spark, sf, "documents"), capacity=CAPACITY)


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark")).select("doc_id", "item_id")


def p9_pieces(spark: SparkSession, sf: str) -> DataFrame:
    """Pieces of the oversized documents."""
    return split_documents(table(spark, sf, "documents"), limit=LIMIT, overlap=OVERLAP)


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    pieces = split_documents(table(spark, sf, "documents"), limit=LIMIT, overlap=OVERLAP, with_text=False)
    return pieces.where("piece_no = 1").select("doc_id").distinct()


def p7_cover(spark: SparkSession, sf: str) -> DataFrame:
    """Of every document the tokens and characters that its pieces hold, and whether it is cut only where it has to be."""
    p = p7_packing(spark, sf)
    size = F.col("token_end") - F.col("token_start")
    g = p.groupBy("doc_id").agg(F.sum(size).alias("n_tokens"), F.count(F.lit(1)).alias("n_pieces"), F.sum(F.col("char_end") - F.col("char_start")).alias("n_chars"), F.count_distinct("piece_no").alias("k"))
    return g.select("doc_id", "n_tokens", "n_pieces", "n_chars", (F.col("k") == F.col("n_pieces")).alias("once"))


def p7_sequences(spark: SparkSession, sf: str) -> DataFrame:
    """Totals of the packing: all tokens, no sequence over its capacity or with a gap, and little more sequences than the tokens need."""
    p = p7_packing(spark, sf).withColumn("size", F.col("token_end") - F.col("token_start")).where("size > 0")
    seq = p.groupBy("sequence_id").agg(F.sum("size").alias("held"), F.max(F.col("sequence_offset") + F.col("size")).alias("ends"), F.count(F.lit(1)).alias("k"), F.count_distinct("sequence_offset").alias("starts"))
    g = seq.agg(F.sum("held").alias("tokens"), F.count(F.lit(1)).alias("n"), F.max("held").alias("most"), F.bool_and((F.col("held") == F.col("ends")) & (F.col("k") == F.col("starts"))).alias("gapless"))
    return g.select("tokens", (F.col("most") <= CAPACITY).alias("fits"), "gapless", (F.col("n") <= F.ceil(F.col("tokens") / CAPACITY) * 1.01 + 1).alias("near_bound"))


def p9_cover(spark: SparkSession, sf: str) -> DataFrame:
    """Of every document that is split: its tokens, those that the pieces hold without what they repeat, whether all pieces fit and repeat what they should, and the digest of the text that they make up."""
    from pyspark.sql import Window

    w = Window.partitionBy("doc_id").orderBy("piece_no")
    p = p9_pieces(spark, sf).withColumn("before", F.lag("token_end").over(w)).withColumn("chars", F.coalesce(F.lag("char_end").over(w), F.col("char_start")))
    new = F.expr("substring(piece, cast(chars - char_start AS INT) + 1)")
    g = p.groupBy("doc_id").agg(
        F.max("n_tokens").alias("n_tokens"), F.sum(F.col("token_end") - F.coalesce("before", F.lit(0))).alias("covered"),
        F.bool_and(F.col("token_end") - F.col("token_start") <= LIMIT).alias("fits"), F.bool_and(F.col("before").isNull() | (F.col("token_start") == F.col("before") - OVERLAP)).alias("overlaps"),
        F.array_sort(F.collect_list(F.struct("piece_no", new.alias("t")))).alias("parts"),
    )
    return g.select("doc_id", "n_tokens", "covered", "fits", "overlaps", F.md5(F.array_join(F.transform("parts", lambda x: x["t"]), "")).alias("digest"))


QUERIES = {f.__name__: f for f in (p4_found, p6_found, p6_records, p6_survivors, p7_packing, p7_cover, p7_sequences, p8_found, p9_found, p9_pieces, p9_cover)}

# Tokens counted by patterns without look-ahead: words, numbers and signs, each with a blank before it; of longer white space
# before them all but the last character is a token; so is a last character that is no blank, and white space at the end.
_NOT_BLANK = r"\t\n\v\f\r\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_WHITE = _NOT_BLANK + " "
_COUNT = lambda pattern: f"len(regexp_extract_all(text, $${pattern}$$))"
_RUN = rf"'(?:s|t|re|ve|m|ll|d)| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WHITE}\p{{L}}\p{{N}}]+"
_TOKENS = f"SELECT doc_id, text, CASE WHEN text IS NULL THEN 0 ELSE {_COUNT(_RUN)} + {_COUNT(f'[{_WHITE}][{_WHITE}]+[^{_WHITE}]')} + {_COUNT(f'[{_NOT_BLANK}][^{_WHITE}]')} + CASE WHEN regexp_matches(text, $$[{_WHITE}]\\z$$) THEN 1 ELSE 0 END END AS n FROM documents"
_P7_COVER = f"SELECT doc_id, sum(n)::BIGINT AS n_tokens, sum(greatest(1, (n + {CAPACITY - 1}) // {CAPACITY}))::BIGINT AS n_pieces, sum(coalesce(length(text), 0))::BIGINT AS n_chars, true AS once FROM ({_TOKENS}) GROUP BY 1"
_P7_SEQUENCES = f"SELECT sum(n)::BIGINT AS tokens, true AS fits, true AS gapless, true AS near_bound FROM ({_TOKENS})"
_P9_FOUND = f"SELECT DISTINCT doc_id FROM ({_TOKENS}) WHERE n > {LIMIT}"
_P9_COVER = f"SELECT doc_id, n AS n_tokens, n AS covered, true AS fits, true AS overlaps, md5(text) AS digest FROM ({_TOKENS}) WHERE n > {LIMIT}"

_UNKNOWN = ", ".join(f"'{u}'" for u in UNKNOWN)
_KNOWN = lambda c: f"CASE WHEN lower(trim({c})) NOT IN ({_UNKNOWN}) THEN trim({c}) END"
_FILLED = "(a0.accessibility_flag IS NOT NULL)::INT + (a0.building IS NOT NULL)::INT + (a0.staircase IS NOT NULL)::INT + (a0.pir_code IS NOT NULL)::INT + (a0.point IS NOT NULL)::INT"
_P6 = f"""
WITH pairs AS (SELECT DISTINCT canonical_address_id AS g, original_address_id AS id FROM address_mapping WHERE canonical_address_id IS NOT NULL AND original_address_id IS NOT NULL),
rec AS (SELECT DISTINCT id, coalesce(t.trust_rank, -1000000) AS rank, coalesce(epoch_us(c.updated_at), -1e18::BIGINT) AS time,
        {_KNOWN("accessibility_flag")} AS accessibility_flag, {_KNOWN("building")} AS building, {_KNOWN("staircase")} AS staircase, {_KNOWN("pir_code")} AS pir_code,
        CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN struct_pack(latitude := latitude, longitude := longitude) END AS point
        FROM canonical_address c LEFT JOIN source_trust t USING (record_source) WHERE id IS NOT NULL),
j AS (SELECT p.g, r.* FROM pairs p JOIN rec r USING (id)),
big AS (SELECT g FROM j GROUP BY g HAVING count(DISTINCT id) > 1),
m AS (SELECT a0.*, {_FILLED} AS filled FROM j a0 JOIN big USING (g))"""
_P6_FOUND = _P6 + """,
behind AS (SELECT a.g, a.id FROM m a WHERE NOT EXISTS (
  SELECT 1 FROM m b WHERE b.g = a.g AND (b.rank > a.rank OR b.time > a.time
    OR (a.accessibility_flag IS NULL AND b.accessibility_flag IS NOT NULL) OR (a.building IS NULL AND b.building IS NOT NULL)
    OR (a.staircase IS NULL AND b.staircase IS NOT NULL) OR (a.pir_code IS NULL AND b.pir_code IS NOT NULL) OR (a.point IS NULL AND b.point IS NOT NULL))))
SELECT g AS canonical_address_id, min(id) AS original_address_id FROM behind GROUP BY g HAVING count(*) = 1"""

_BEST = lambda c: f"first({c} ORDER BY {c} IS NOT NULL DESC, rank DESC, time DESC, filled DESC, id DESC, {c} DESC) AS {c}"
_P6_SURVIVORS = _P6 + f"""
SELECT g AS canonical_address_id, n_records, accessibility_flag, building, staircase, pir_code, point.latitude AS latitude, point.longitude AS longitude, latest, w.original_address_id AS whole_record_id
FROM (SELECT g, count(*) AS n_records, {", ".join(map(_BEST, ("accessibility_flag", "building", "staircase", "pir_code", "point")))},
      CASE WHEN max(time) > -1e18::BIGINT THEN make_timestamp(max(time)) END AS latest FROM m GROUP BY g) s
LEFT JOIN ({_P6_FOUND}) w ON w.canonical_address_id = s.g"""
_P6_RECORDS = f"""
WITH pairs AS (SELECT DISTINCT canonical_address_id AS g, original_address_id AS id FROM address_mapping WHERE canonical_address_id IS NOT NULL AND original_address_id IS NOT NULL),
rec AS (SELECT DISTINCT id, coalesce(t.trust_rank, -1000000) AS rank, coalesce(epoch_us(c.updated_at), -1e18::BIGINT) AS time,
        {", ".join(f"{_KNOWN(c)} AS {c}" for c in ("accessibility_flag", "building", "staircase", "pir_code", *DESCRIPTION, "geocoding_quality"))},
        CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN struct_pack(latitude := latitude, longitude := longitude) END AS point
        FROM canonical_address c LEFT JOIN source_trust t USING (record_source) WHERE id IS NOT NULL),
j AS (SELECT p.g, a0.*, {_FILLED} AS filled FROM pairs p JOIN rec a0 USING (id)),
s AS (SELECT g, count(*) AS n_records, {", ".join(map(_BEST, ("accessibility_flag", "building", "staircase", "pir_code", "point")))}, {", ".join(map(_BEST, DESCRIPTION))},
      first(geocoding_quality ORDER BY point IS NOT NULL DESC, (point IS NOT NULL OR geocoding_quality IS NOT NULL) DESC, rank DESC, time DESC, filled DESC, id DESC, geocoding_quality DESC NULLS LAST) AS geocoding_quality,
      CASE WHEN max(time) > -1e18::BIGINT THEN make_timestamp(max(time)) END AS latest FROM j GROUP BY g HAVING count(DISTINCT id) > 1)
SELECT g AS canonical_address_id, n_records, accessibility_flag, building, staircase, pir_code, {", ".join(DESCRIPTION)}, geocoding_quality, point.latitude AS latitude, point.longitude AS longitude, latest, w.original_address_id AS whole_record_id
FROM s LEFT JOIN ({_P6_FOUND}) w ON w.canonical_address_id = s.g"""
ORACLE = {"p7_cover": _P7_COVER, "p7_sequences": _P7_SEQUENCES, "p9_found": _P9_FOUND, "p9_cover": _P9_COVER, "p6_found": _P6_FOUND, "p6_records": _P6_RECORDS, "p6_survivors": _P6_SURVIVORS}
