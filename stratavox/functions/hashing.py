"""Stable digests of identities: SHA-256 over canonical JSON text or NUL-joined parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUL = chr(0)


def json_text(part: Column) -> Column:
    """A part as a JSON string literal, other characters than quotes, backslashes and NUL kept."""
    text = F.replace(F.replace(part.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.concat(F.lit('"'), F.replace(text, F.lit(NUL), F.lit("\\u0000")), F.lit('"'))


def json_digest(domain: str, *parts: Column) -> Column:
    """Hex SHA-256 of the JSON array of a domain and parts."""
    listed = F.concat_ws(",", json_text(F.lit(domain)), *map(json_text, parts))
    return F.sha2(F.concat(F.lit("["), listed, F.lit("]")), 256)


def joined_digest(*parts: Column) -> Column:
    """Hex SHA-256 of the parts joined by NUL."""
    return F.sha2(F.concat_ws(NUL, *(p.cast("string") for p in parts)), 256)


def leading_u32(digest: Column) -> Column:
    """The first four bytes of a hex digest, big-endian."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def fnv1a32(text: Column) -> Column:
    """FNV-1a of the UTF-8 bytes, 32 bits."""
    codes = F.transform(F.sequence(F.lit(1), F.octet_length(text)), lambda i: F.conv(F.substring(F.hex(text), i * 2 - 1, F.lit(2)), 16, 10).cast("bigint"))
    return F.when(F.octet_length(text) == 0, F.lit(2166136261)).otherwise(F.aggregate(codes, F.lit(2166136261).cast("bigint"), lambda h, c: h.bitwiseXOR(c) * 16777619 % (1 << 32)))
