"""Join helpers."""
from __future__ import annotations

from pyspark.sql import functions as F

# Prefix that no real key carries: a NULL join key becomes a unique,
# never-matching value, so NULL-key rows spread over all partitions instead of
# all hashing to one (a left join would keep them unmatched anyway).
_NULL_SALT = "\u0000null:"


def spread_null_key(key, *salt_cols) -> F.Column:
    """Join key for the *left* side of a left join: the key itself, or for a
    NULL key a salted value built from ``salt_cols`` that matches nothing."""
    k = F.col(key) if isinstance(key, str) else key
    salt = F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in salt_cols]).cast("string")
    return F.coalesce(k, F.concat(F.lit(_NULL_SALT), salt))
