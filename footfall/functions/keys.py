"""Hashed keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands for NULL inside a surrogate key.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: Column) -> Column:
    """md5 over the text forms of the columns, joined by dashes."""
    parts = [F.coalesce(c.cast("string"), F.lit(NULL_KEY_PART)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def hash_bucket(c: Column, seed: int, buckets: int) -> Column:
    """A bucket number that depends on the value and the seed only, never on the plan."""
    digest = F.md5(F.concat_ws(":", c.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets
