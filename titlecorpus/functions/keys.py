"""Seeded, engine-independent hash keys.

``md5('<seed>:<key>')`` is a uniform, reproducible sort key: the same rows come
out for the same seed on any cluster size, and the hex digits double as
order-preserving buckets (its first hex digits), which is what the exact
rank and cut operators use instead of a one-partition window.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_hash(key, seed) -> Column:
    """md5 hex of '<seed>:<key>' (a NULL key hashes like an empty one); ``seed`` may be a value or a Column."""
    k = F.col(key) if isinstance(key, str) else key
    k = F.coalesce(k.cast("string"), F.lit(""))
    if isinstance(seed, Column):
        return F.md5(F.concat(seed.cast("string"), F.lit(":"), k.cast("string")))
    return F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string")))


def hex_prefix_int(h: Column, digits: int) -> Column:
    """Integer value of the first ``digits`` hex digits of an md5 string."""
    return F.conv(F.substring(h, 1, digits), 16, 10).cast("long")


def seeded_int(key, seed) -> Column:
    """32-bit non-negative integer drawn from md5('<seed>:<key>')."""
    return hex_prefix_int(seeded_hash(key, seed), 8)
