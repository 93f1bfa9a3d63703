"""Keyed pseudonyms and masks as Spark SQL expressions; nothing leaves the JVM.

The padded key appears as a literal in the query plan: do not log or share plans that
contain a pseudonym.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK_BYTES = 64
PREFIX = "px_"


def padded_keys(pepper: str) -> tuple[bytes, bytes]:
    """Inner and outer key of HMAC-SHA256 (RFC 2104)."""
    secret = pepper.encode("utf-8")
    if len(secret) > BLOCK_BYTES:
        secret = hashlib.sha256(secret).digest()
    secret += bytes(BLOCK_BYTES - len(secret))
    return bytes(0x36 ^ b for b in secret), bytes(0x5C ^ b for b in secret)


# Every character that counts as whitespace in Unicode text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip_whitespace(value: Column) -> Column:
    """Remove leading and trailing whitespace of every kind, not only spaces."""
    return F.btrim(value, F.lit(WHITESPACE))


def pseudonym(value: Column, pepper: str) -> Column:
    """``px_`` and the first 32 hex digits of the keyed hash of the normalised value.

    NULL and blank values stay NULL: otherwise everybody without an id would become one
    person.
    """
    inner_key, outer_key = padded_keys(pepper)
    text = F.nullif(F.lower(strip_whitespace(value)), F.lit(""))
    inner = F.sha2(F.concat(F.lit(inner_key), text.cast("binary")), 256)
    digest = F.sha2(F.concat(F.lit(outer_key), F.unhex(inner)), 256)
    return F.concat(F.lit(PREFIX), F.substring(digest, 1, 32))


def last_four(value: Column) -> Column:
    """``***`` and the last four letters or digits; only ``***`` if there are fewer."""
    kept = F.regexp_replace(value, "[^A-Za-z0-9]", "")
    tail = F.when(F.length(kept) >= 4, F.right(kept, F.lit(4))).otherwise(F.lit(""))
    return F.when(value.isNotNull(), F.concat(F.lit("***"), tail))
