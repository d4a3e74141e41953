"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_spreading_nulls(left: DataFrame, right: DataFrame, key: str, spread_by: str, buckets: int = 256) -> DataFrame:
    """Left join on `key` where many left rows may have no key at all.

    NULL never matches, yet a shuffle would send every NULL to one task. A salt
    that differs only for NULL keys (taken from `spread_by`) scatters them.
    """
    salt = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(spread_by), F.lit(buckets))).otherwise(F.lit(-1).cast("bigint"))
    return (
        left.withColumn("_salt", salt)
        .join(right.withColumn("_salt", F.lit(-1).cast("bigint")), [key, "_salt"], "left")
        .drop("_salt")
    )
