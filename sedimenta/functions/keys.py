"""Hash keys, content hashes, canonical fingerprints and signatures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text that stands for NULL inside a key, and the separator.
NULL_IN_KEY = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"

HMAC_BLOCK = 64


def surrogate_key(*columns: str | Column) -> Column:
    """MD5 over the text of the columns; NULLs take part, so the key is never NULL."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    texts = [F.coalesce(p.cast("string"), F.lit(NULL_IN_KEY)) for p in parts]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *texts))


def content_hash(*columns: str | Column) -> Column:
    """The same formula over attribute columns. Give doubles through `number_text`, which keeps every digit."""
    return surrogate_key(*columns)


def fingerprint(columns: Mapping[str, Column], length: int = 16) -> Column:
    """SHA-256 of the canonical JSON (keys sorted, NULLs kept), cut to `length` hex digits."""
    body = F.struct(*[columns[name].alias(name) for name in sorted(columns)])
    return F.substring(F.sha2(F.to_json(body, {"ignoreNullFields": "false"}), 256), 1, length)


def hmac_sha256(message: Column, key: bytes) -> Column:
    """HMAC-SHA256 (RFC 2104) in hex, from two nested SHA-256 calls that stay inside codegen."""
    if len(key) > HMAC_BLOCK:
        raise ValueError("give a key of at most 64 bytes")
    block = key.ljust(HMAC_BLOCK, b"\0")
    inner_pad = F.lit(bytes(b ^ 0x36 for b in block))
    outer_pad = F.lit(bytes(b ^ 0x5C for b in block))
    inner = F.unhex(F.sha2(F.concat(inner_pad, F.encode(message, "UTF-8")), 256))
    return F.sha2(F.concat(outer_pad, inner), 256)


def joined_key(columns: Sequence[str | Column], separator: str) -> Column:
    """Columns joined by a separator, NULL as ''."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.concat_ws(separator, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def derived_key(info: Column, key: bytes) -> Column:
    """A key of 32 bytes for `info`, as binary: the first block of HKDF-Expand (RFC 5869) with HMAC-SHA256 under `key`."""
    return F.unhex(hmac_sha256(F.concat(F.coalesce(info, F.lit("")), F.lit("\x01")), key))
