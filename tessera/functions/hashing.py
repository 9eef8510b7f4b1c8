"""Feature hashing: md5 of the key text, taken as a 128-bit integer, mod m.

The 128-bit value is folded in four 32-bit chunks, most significant first:
``r = (r * (2^32 mod m) + chunk) mod m`` — exact in 64-bit arithmetic for
``m < 2^31``, so no Python is involved.
"""
from __future__ import annotations

from pyspark.sql import Column, functions as F


def md5_bucket(key, num_buckets: int) -> Column:
    if not 0 < num_buckets < 2 ** 31:
        raise ValueError("num_buckets must be in (0, 2^31)")
    k = F.col(key) if isinstance(key, str) else key
    mult, m = (2 ** 32) % num_buckets, F.lit(num_buckets).cast("long")

    def fold(h):
        # where 2^32 is a multiple of the buckets, only the last chunk counts
        r = F.lit(0).cast("long")
        for i in range(4) if mult else (3,):
            chunk = F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("long")
            r = F.pmod(r * F.lit(mult).cast("long") + chunk, m) if mult and i else F.pmod(chunk, m)
        return r.cast("int")

    if not mult:
        return fold(F.md5(k))
    return F.transform(F.array(F.md5(k)), fold)[0]  # the hash is named, so that it is taken once


def feature_key(feature_id, category) -> Column:
    """Key text ``category:featureID``."""
    return F.concat(category, F.lit(":"), feature_id.cast("string"))
