"""Joins on keys of which one may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot above this share of the rows, so at most 1000 keys are hot.
HOT_SHARE = 1 / 1000


def hot_keys(counts: DataFrame, key: str, n: str = "n", share: float = HOT_SHARE) -> DataFrame:
    """(key, salts): keys above ``share`` of all rows, never more than ``1 / share`` of them.

    A key gets a salt for every ``share`` of the rows that it holds, so no salt
    stands for more than that.
    """
    total = counts.agg(F.sum(n).alias("total")).scalar()
    part = total * F.lit(share)
    return counts.where(F.col(n) > part).select(key, F.ceil(F.col(n) / part).alias("salts"))


def salted_join(rows: DataFrame, keyed: DataFrame, key: str, counts: DataFrame, how: str = "left") -> DataFrame:
    """Join ``rows`` to ``keyed`` (one row per key) with hot keys split.

    Rows of a hot key are dealt out over its salts in turn; the hot rows of
    ``keyed`` are repeated once per salt. ``counts`` gives ``n`` rows per key.
    Null is an ordinary key.
    """
    hot = hot_keys(counts, key).select(F.col(key).alias("_hot_key"), F.col("salts").alias("_salts"))

    left = rows.join(F.broadcast(hot), rows[key].eqNullSafe(F.col("_hot_key")), "left").withColumn(
        "_salt", F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col("_salts")), F.lit(0))
    )
    every = F.sequence(F.lit(0).cast("bigint"), F.coalesce("_salts", F.lit(1)) - 1)
    right = (
        keyed.withColumnRenamed(key, "_join_key")
        .join(F.broadcast(hot), F.col("_join_key").eqNullSafe(F.col("_hot_key")), "left")
        .withColumn("_join_salt", F.explode(every))
        .drop("_hot_key", "_salts")
    )
    matches: Column = F.col(key).eqNullSafe(F.col("_join_key")) & (F.col("_salt") == F.col("_join_salt"))
    joined = left.join(right, matches, how)
    return joined.drop("_hot_key", "_salts", "_salt", "_join_key", "_join_salt")
