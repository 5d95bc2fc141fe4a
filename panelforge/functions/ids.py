"""Stable keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_id(*parts: Column, length: int = 16, prefix: str = "") -> Column:
    """The first digits of the SHA-256 of the parts, joined by |; a null part is empty."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(prefix), F.substring(F.sha2(text, 256), 1, length))


def salted_hash(c: Column, salt: str, length: int = 20) -> Column:
    return F.substring(F.sha2(F.concat(F.lit(salt + ":"), c), 256), 1, length)


def md5_key(*parts: Column) -> Column:
    """md5 of the parts joined by a colon; null if one is."""
    out = parts[0].cast("string")
    for p in parts[1:]:
        out = F.concat(out, F.lit(":"), p.cast("string"))
    return F.md5(out)
