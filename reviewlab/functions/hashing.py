"""Seeded hashes of the row key: the only source of randomness in the library.

A draw is a function of the key alone, so it is the same under any partitioning,
after a retry of a lost task, and in any other engine that has MD5.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from reviewlab.functions.text import _col

HASH_BITS = 60
#: Equal slices of the hash range that ranking counts before it looks at rows.
BUCKET_BITS = 14


def seeded_hash(key: Column | str, seed: int | str) -> Column:
    """60-bit non-negative hash of ``seed:key``."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), _col(key).cast("string")))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def hash_bucket(h: Column | str, bits: int = BUCKET_BITS) -> Column:
    """Leading bits of the hash: buckets in hash order, of near-equal size."""
    return F.shiftright(_col(h), HASH_BITS - bits).cast("int")


def uniform(key: Column | str, seed: int | str) -> Column:
    """Uniform draw in [0, 1)."""
    # 52 leading bits: exactly representable, so the draw never rounds up to 1.
    return F.shiftright(seeded_hash(key, seed), HASH_BITS - 52) / F.lit(float(1 << 52))
