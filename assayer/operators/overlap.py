"""Which keys occur in more than one split.

One shuffle per key: each key collapses map-side to a bit mask of its splits, so a key
that fills a third of the table costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.functions.text import pair_key
from assayer.labels import SPLITS
from assayer.operators.membership import may_hold
from assayer.operators.skew import hot_keys, salted_join
from assayer.session import materialize


def split_pairs(records: DataFrame, splits: Sequence[str] = SPLITS) -> DataFrame:
    """All unordered pairs of the splits that occur, earlier one first."""
    order = F.array(*[F.lit(s) for s in splits])
    # Only known names are collected, so there is at most one element per split.
    present = records.filter(F.col("split").isin(*splits)).agg(F.collect_set("split").alias("seen")).select(
        F.filter(order, lambda s: F.array_contains("seen", s)).alias("seen")
    )
    firsts = present.select("seen", F.posexplode("seen").alias("i", "split_a"))
    return firsts.select(
        "split_a", F.explode(F.slice("seen", F.col("i") + 2, F.size("seen"))).alias("split_b")
    ).select("split_a", "split_b", pair_key(F.col("split_a"), F.col("split_b"), "vs").alias("pair"))


def key_masks(records: DataFrame, key: str, splits: Sequence[str] = SPLITS) -> DataFrame:
    """``key, mask, rows``: bit i of the mask is set when split i holds the key."""
    order = F.array(*[F.lit(s) for s in splits])
    position = F.array_position(order, F.col("split")).cast("int")
    bit = F.when(position > 0, F.call_function("shiftleft", F.lit(1), position - 1)).otherwise(F.lit(0))
    return records.groupBy(key).agg(
        F.bit_or(bit).alias("mask"), F.count(F.lit(1)).alias("rows")
    )


def overlap_counts(records: DataFrame, key: str, splits: Sequence[str] = SPLITS) -> DataFrame:
    """``pair, overlap``: distinct keys in both splits of each pair, zeros included."""
    pairs = list(combinations(range(len(splits)), 2))
    counts = key_masks(records, key, splits).agg(
        *[
            F.count_if(F.col("mask").bitwiseAND((1 << i) | (1 << j)) == ((1 << i) | (1 << j))).alias(
                f"{splits[i]}_vs_{splits[j]}"
            )
            for i, j in pairs
        ]
    )
    cells = [
        F.struct(F.lit(name).alias("pair"), F.col(name).alias("overlap")) for name in counts.columns
    ]
    return counts.select(F.explode(F.array(*cells)).alias("c")).select("c.pair", "c.overlap")


def shared_keys(records: DataFrame, key: str, splits: Sequence[str] = SPLITS) -> DataFrame:
    """``pair, key``: the keys themselves, one row per pair that shares them."""
    pairs = [
        F.struct(
            F.lit((1 << i) | (1 << j)).alias("need"),
            F.lit(f"{splits[i]}_vs_{splits[j]}").alias("pair"),
        )
        for i, j in combinations(range(len(splits)), 2)
    ]
    masks = key_masks(records, key, splits)
    return (
        masks.select(key, "mask", F.explode(F.array(*pairs)).alias("p"))
        .filter(F.col("mask").bitwiseAND(F.col("p.need")) == F.col("p.need"))
        .select("p.pair", key)
    )


def held_out_keys(records: DataFrame, key: str, train: str = "train") -> DataFrame:
    """``key, in_train, rows`` of every key outside ``train``, checkpointed.

    It answers two questions, which keys are shared and which are hot, so it is kept: the keys
    are far smaller than the texts they were computed from. Only the rows of ``train`` that pass a
    bitmap of the held-out keys are shuffled: ``train`` may be many times larger.
    """
    is_train = F.col("split") == train
    held = materialize(records.filter(~is_train).groupBy(key).agg(F.count(F.lit(1)).alias("rows")))
    seen = may_hold(records.filter(is_train).select(key), held, key).filter("may_hold").select(key).distinct()
    found = held.join(seen.withColumn("in_train", F.lit(True)), key, "left")
    return materialize(found.select(key, F.coalesce("in_train", F.lit(False)).alias("in_train"), "rows"))


def mark_lookalikes(
    records: DataFrame, key: str, train: str = "train", salt_from: str = "ordinal"
) -> DataFrame:
    """Rows outside ``train`` with ``lookalike``: whether their key also occurs in it.

    ``records`` is read several times, so hand in a narrow checkpointed table, not whole texts. Rows
    whose key cannot be shared are not shuffled; the rows of a key with very many copies are spread
    over salts.
    """
    keys = held_out_keys(records, key, train)
    shared = keys.filter("in_train").select(key, F.lit(True).alias("lookalike"))
    held_out = may_hold(records.filter(F.col("split") != train), shared, key)
    near = held_out.filter("may_hold").drop("may_hold")
    far = held_out.filter("not may_hold").drop("may_hold").withColumn("lookalike", F.lit(False))
    marked = salted_join(near, shared, key, hot_keys(keys, key, "rows"), salt_from, "left")
    return marked.withColumn("lookalike", F.coalesce("lookalike", F.lit(False))).unionByName(far)


def lookalikes(
    records: DataFrame,
    key: str,
    train: str = "train",
    salt_from: str = "ordinal",
    keep: bool = True,
) -> DataFrame:
    """Only the rows outside ``train`` whose key also occurs in it, or (``keep=False``) does not."""
    marked = mark_lookalikes(records, key, train, salt_from)
    return marked.filter(F.col("lookalike") == F.lit(keep)).drop("lookalike")
