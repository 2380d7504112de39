"""Which keys may occur in a set: a hashed bitmap of fixed size, broadcast, in SQL functions only.

The bitmap has 2^27 bits in 4,096 rows of 4 KiB, 16 MiB in all, whatever the size of the set, so
broadcasting it is bounded. A key of the set always finds its bit; a key outside may find one by
chance. It keeps rows that cannot match out of a shuffle, and an exact join follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 27
ROW_BITS = 32_768


def _place(hashed: Column) -> tuple[Column, Column]:
    """Row of the bitmap, and bit within it."""
    at = F.pmod(hashed, F.lit(BITS))
    return F.floor(at / F.lit(ROW_BITS)).cast("int"), (at % ROW_BITS).cast("int")


def bitmap(hashes: DataFrame, col: str) -> DataFrame:
    """``_bits_row, _bits`` of a column of hashes: at most 4,096 rows."""
    row, bit = _place(F.col(col))
    return hashes.select(row.alias("_bits_row"), bit.cast("long").alias("_bit")).groupBy("_bits_row").agg(
        F.bitmap_construct_agg("_bit").alias("_bits")
    )


def flagged(df: DataFrame, hashed: Column, bits: DataFrame, flag: str) -> DataFrame:
    """``df`` with ``flag``: whether the key with that hash may be in the set."""
    row, bit = _place(hashed)
    joined = df.withColumns({"_want_row": row, "_want_bit": bit}).join(
        F.broadcast(bits), F.col("_want_row") == F.col("_bits_row"), "left"
    )
    byte = F.conv(F.hex(F.substring("_bits", F.floor(F.col("_want_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), F.col("_want_bit") % 8)) != 0
    return joined.withColumn(flag, F.coalesce(is_set, F.lit(False))).drop("_want_row", "_want_bit", "_bits_row", "_bits")
