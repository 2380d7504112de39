"""Which rows may have a key of a set: a hashed bitmap, sized by a count of the set, in SQL functions.

The bitmap has at least 16 bits a key, so that about one row in 16 without such a key passes, and at
most 2^27 bits, which is 16 MiB: broadcasting it is bounded whatever the size of the set. Beyond
that size more rows pass. No row with a key of the set is ever lost; an exact join has to follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16
MAX_BITS = 1 << 27
ROW_BITS = 1 << 15  # what one aggregate of Spark's bitmap functions holds


def bits_for(keys: int) -> int:
    """The size of the bitmap of so many keys: a power of two from one row to ``MAX_BITS``."""
    return min(max(1 << max(BITS_PER_KEY * keys - 1, 0).bit_length(), ROW_BITS), MAX_BITS)


def _place(key: str, bits: int) -> tuple[Column, Column]:
    at = F.pmod(F.xxhash64(key), F.lit(bits))
    return F.floor(at / F.lit(ROW_BITS)).cast("int"), (at % ROW_BITS).cast("int")


def may_hold(rows: DataFrame, keys: DataFrame, key: str, flag: str = "may_hold") -> DataFrame:
    """``rows`` with ``flag``: False only where ``key`` is none of ``keys``. Nothing is shuffled but bits.

    ``keys`` is counted first, so hand in a stored table that holds each key once.
    """
    bits = bits_for(keys.count())
    row, bit = _place(key, bits)
    table = keys.select(row.alias("_row"), bit.cast("long").alias("_bit")).groupBy("_row").agg(
        F.bitmap_construct_agg("_bit").alias("_bits")
    )
    joined = rows.withColumns({"_want": row, "_at": bit}).join(F.broadcast(table), F.col("_want") == F.col("_row"), "left")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(F.col("_at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), F.col("_at") % 8)) != 0
    return joined.withColumn(flag, F.coalesce(is_set, F.lit(False))).drop("_want", "_at", "_row", "_bits")
