"""Hash placement without a UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_mod(key: Column, buckets: int) -> Column:
    """The 128-bit md5 of ``key`` modulo ``buckets``.

    No SQL integer holds 128 bits, so the digest is folded 32 bits at a time; every step stays
    below 2^32 * buckets.
    """
    digest = F.md5(key)
    carry = 2**32 % buckets
    remainder = F.lit(0).cast("bigint")
    for start in (1, 9, 17, 25):
        word = F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")
        remainder = (remainder * carry + word) % buckets
    return remainder.cast("int")
