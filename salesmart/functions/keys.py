"""Surrogate keys: a deterministic whole number from the business key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Hexadecimal digits of the hash that make the key (60 bits), and what joins several parts.
KEY_DIGITS = 15
PART_SEPARATOR = "|"


def surrogate_key(*business_key: Column) -> Column:
    """60 bits of the MD5 of the key's text; NULL when any part is NULL.

    Loads on different days and on different tables agree on the key without a lookup join, and any
    SQL engine with MD5 can compute it too.
    """
    parts = [c.cast("string") for c in business_key]
    filled = reduce(lambda a, b: a & b, [p.isNotNull() for p in parts])
    text = parts[0] if len(parts) == 1 else F.concat_ws(PART_SEPARATOR, *parts)
    return F.when(filled, F.conv(F.substring(F.md5(text), 1, KEY_DIGITS), 16, 10).cast("bigint"))
