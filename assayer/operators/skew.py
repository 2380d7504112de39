"""Joins that survive a key with a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds at least 1 / MAX_HOT_KEYS of the rows, so there can be no
# more than MAX_HOT_KEYS of them: the broadcast list below has a fixed bound.
MAX_HOT_KEYS = 1000


def hot_keys(counts: DataFrame, key: str, rows: str, max_keys: int = MAX_HOT_KEYS) -> DataFrame:
    """``key, salts`` of the keys that hold at least ``1 / max_keys`` of all rows.

    A key gets as many salts as shares of ``1 / max_keys`` it holds, so that no salt holds much
    more than one share. All keys together have at most ``2 * max_keys`` salts.
    """
    total = counts.agg(F.sum(rows)).scalar()
    salts = F.ceil(F.col(rows) * F.lit(max_keys) / F.greatest(total, F.lit(1))).cast("int")
    return counts.filter(F.col(rows) * F.lit(max_keys) >= total).select(key, salts.alias("salts"))


def salted_join(
    fact: DataFrame, dim: DataFrame, key: str, hot: DataFrame, salt_from: str, how: str = "inner"
) -> DataFrame:
    """Equi-join on ``key``; the rows of hot keys are spread over their salts.

    ``dim`` holds each key once. ``hot`` is the bounded list from :func:`hot_keys`. The
    salt comes from a column, not from a random number, so a retried task repeats it.
    """
    flag = F.broadcast(hot.select(F.col(key).alias("_hot"), F.col("salts").alias("_salts")))
    spread = F.pmod(F.xxhash64(salt_from), F.col("_salts")).cast("int")
    left = fact.join(flag, F.col(key) == F.col("_hot"), "left").withColumn(
        "_salt", F.when(F.col("_hot").isNotNull(), spread).otherwise(F.lit(0))
    )
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    right = dim.join(flag, F.col(key) == F.col("_hot"), "left").withColumn("_salt", F.explode(copies))
    extra = ("_hot", "_salts")
    return left.drop(*extra).join(right.drop(*extra), [key, "_salt"], how).drop("_salt")
