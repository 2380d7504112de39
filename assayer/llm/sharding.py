"""Shards by a Feistel permutation of global row numbers.

Rows are numbered from 0 in the order of id, checksum and size. A keyed Feistel network
permutes the smallest power of four that holds all numbers, and cycle walking applies it again
until the result is a row number, which makes a permutation of exactly those numbers. The
place ``p`` of a row gives shard ``p % shards`` and slot ``p // shards``: shard sizes differ by
one row at most, slots have no gaps, and both follow from number, row count and seed alone.

Null ids come first. Null texts count as empty. Rows that agree in id, checksum and size are
interchangeable, so repeated rows give the same rows in any order; a group of equal texts is
spread like any other rows. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.session import materialize

ROUNDS = 6


def _mix(half: np.ndarray, key: int, mask: np.uint64) -> np.ndarray:
    h = half * np.uint64(0x9E37_79B9_7F4A_7C15) + np.uint64(key)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8_FEB8_6659_FD93)
    h ^= h >> np.uint64(29)
    return h & mask


def _keys(seed: int) -> list[int]:
    state = np.random.default_rng(seed)
    return [int(k) for k in state.integers(0, 1 << 63, ROUNDS)]


def permute(rows: np.ndarray, total: int, seed: int, inverse: bool = False) -> np.ndarray:
    """The places of ``rows`` among ``total``; with ``inverse`` the rows at those places."""
    half = np.uint64(max(1, ((total - 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    keys = _keys(seed)
    out = np.asarray(rows, np.uint64).copy()
    open_ = np.arange(len(out))
    while len(open_):
        left, right = out[open_] >> half, out[open_] & mask
        if inverse:
            for key in reversed(keys):
                left, right = right ^ _mix(left, key, mask), left
        else:
            for key in keys:
                left, right = right, left ^ _mix(right, key, mask)
        out[open_] = left << half | right
        open_ = open_[out[open_] >= total]
    return out.astype(np.int64)


def shard_and_slot(rows: np.ndarray, total: int, shards: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    places = permute(rows, total, seed)
    return places % shards, places // shards


def row_at(shard: int, slot: int, total: int, shards: int, seed: int) -> int:
    """The number of the row in a slot of a shard, without any table."""
    return int(permute(np.array([slot * shards + shard]), total, seed, inverse=True)[0])


def assign_shards(
    docs: DataFrame, shards: int, seed: int = 20_240_601, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, size, text_crc32, shard, slot`` of every row.

    Only the narrow digest is sorted and checkpointed, so that the numbers of a lost task come
    out the same. The tie column spreads rows that are equal in all three over the partitions.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = docs.select(
        F.col(id_col).alias("_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.monotonically_increasing_id().alias("_tie"),
    )
    ordered = materialize(digest.sort("_id", "text_crc32", "size", "_tie").drop("_tie"))
    # The upper bits of this id name the partition, the lower 33 the row within it.
    numbered = ordered.withColumn("_at", F.monotonically_increasing_id())
    counts = numbered.groupBy(F.shiftright("_at", 33).alias("part")).count().orderBy("part").collect()
    firsts: dict[int, int] = {}
    total = 0
    for part, n in counts:
        firsts[part] = total
        total += n
    parts = np.array(list(firsts) or [0], np.int64)
    starts = np.array(list(firsts.values()) or [0], np.int64)

    def place(at: pd.Series) -> pd.DataFrame:
        where = at.to_numpy()
        rows = starts[np.searchsorted(parts, where >> 33)] + (where & ((1 << 33) - 1))
        shard, slot = shard_and_slot(rows, total, shards, seed)
        return pd.DataFrame({"shard": shard.astype(np.int32), "slot": slot})

    place.__annotations__ = {"at": pd.Series, "return": pd.DataFrame}
    placed = F.pandas_udf(place, T.StructType().add("shard", "integer").add("slot", "long"))
    return numbered.withColumn("_place", placed("_at")).select(
        F.col("_id").alias(id_col), "size", "text_crc32", "_place.shard", "_place.slot"
    )
