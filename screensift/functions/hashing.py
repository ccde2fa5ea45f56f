"""Seeded pseudo-random draws from md5, identical in Spark and in SQL engines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_52 = 4503599627370496.0  # 13 hex digits = 52 bits


def seeded_hash(*parts: Column | str | int) -> Column:
    """md5 hex of the parts joined by '-'."""
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws("-", *[c.cast("string") for c in cols]))


def uniform(*parts: Column | str | int) -> Column:
    """u in [0, 1) from the first 52 bits of md5(parts joined by '-')."""
    h = seeded_hash(*parts)
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("bigint") / F.lit(TWO_POW_52)
