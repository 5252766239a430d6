"""Surrogate keys and identifiers as column expressions; nothing here runs Python for a row."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the name space that exported identifiers are derived in.
NAMESPACE = uuid.uuid3(uuid.NAMESPACE_DNS, "oevk.hu")


def text_of(c: Column | str) -> Column:
    """Column as text, null as empty."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit(""))


def md5_16(*columns: Column | str) -> Column:
    """First 16 hex digits of the MD5 of the columns joined by ``|``; null counts as empty."""
    return F.substring(F.md5(F.concat_ws("|", *map(text_of, columns))), 1, 16)


def cache_key(*columns: Column | str) -> Column:
    """Full MD5 of the columns joined by ``|``; null counts as empty."""
    return F.md5(F.concat_ws("|", *map(text_of, columns)))


def strict_md5_16(*columns: Column | str) -> Column:
    """Like ``md5_16``, but null if any of the columns is."""
    return F.substring(strict_cache_key(*columns), 1, 16)


def strict_cache_key(*columns: Column | str) -> Column:
    """Like ``cache_key``, but null if any of the columns is."""
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    return F.md5(F.concat(texts[0], *(F.concat(F.lit("|"), t) for t in texts[1:])))


def _uuid(digest: Column, version: str) -> Column:
    """Hex digest with version and variant digits, in the usual groups."""
    variant = F.element_at(F.array(*(F.lit(c) for c in "89ab89ab89ab89ab")), F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") + 1)
    # The variant keeps the two low bits of its digit.
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"), F.substring(digest, 9, 4), F.lit("-" + version), F.substring(digest, 14, 3), F.lit("-"),
        variant, F.substring(digest, 18, 3), F.lit("-"), F.substring(digest, 21, 12),
    )


def _named(c: Column) -> Column:
    return F.concat(F.unhex(F.lit(NAMESPACE.hex)), F.encode(c, "UTF-8"))


def uuid3(c: Column | str) -> Column:
    """UUID version 3 of a text in the export name space; null and empty give null."""
    t = text_of(c)
    return F.when(t != "", _uuid(F.md5(_named(t)), "3"))


def uuid5(c: Column | str) -> Column:
    """UUID version 5 of a text in the export name space; null and empty give null."""
    t = text_of(c)
    return F.when(t != "", _uuid(F.sha1(_named(t)), "5"))


def pseudo_uuid3(c: Column | str) -> Column:
    """MD5 of name space text and value in UUID shape with version digit 3, but without variant bits."""
    t = text_of(c)
    d = F.md5(F.concat(F.lit(str(NAMESPACE)), t))
    return F.when(t != "", F.concat(F.substring(d, 1, 8), F.lit("-"), F.substring(d, 9, 4), F.lit("-3"), F.substring(d, 14, 3), F.lit("-"), F.substring(d, 17, 4), F.lit("-"), F.substring(d, 21, 12)))
