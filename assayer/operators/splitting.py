"""Splits that keep groups whole and label shares similar."""

from __future__ import annotations

from collections.abc import Sequence

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayer.labels import LABELS
from assayer.operators.records import argmax_id
from assayer.operators.skew import hot_keys, salted_join
from assayer.session import materialize

# Groups are placed by the first three hexadecimal digits of a seeded MD5, so the table of
# running totals has at most (labels + 1) * 4096 rows however many groups there are.
BUCKET_DIGITS = 3

# For folds over all labels: a group with at least 1/256 of the rows, or of one label's rows, is placed by itself
# (there are at most 256 * (labels + 1) of them); the others are placed by 256 buckets per most frequent label.
OWN_SHARE = 256
FOLD_BUCKET_DIGITS = 2


def group_stratified_split(
    records: DataFrame,
    shares: Sequence[tuple[str, float]],
    seed: int,
    group_col: str = "server_slug",
    label_col: str = "category",
    labels: Sequence[str] = LABELS,
) -> DataFrame:
    """``group, rows, split``: every group lies in exactly one split.

    Groups with the same most frequent label form a stratum. Within a stratum they are
    ordered by a seeded hash and cut where the running row count passes the shares.
    """
    histogram = records.groupBy(group_col).agg(
        F.array(*[F.count_if(F.col(label_col) == label) for label in labels]).alias("by_label"),
        F.count(F.lit(1)).alias("rows"),
    )
    unlabelled = F.array_max("by_label") == 0
    stratum = F.when(unlabelled, F.lit(-1)).otherwise(argmax_id(F.col("by_label")))
    groups = histogram.select(
        group_col,
        "rows",
        stratum.alias("stratum"),
        F.substring(F.md5(F.concat(F.lit(str(seed)), F.col(group_col))), 1, BUCKET_DIGITS).alias("bucket"),
    )
    buckets = groups.groupBy("stratum", "bucket").agg(F.sum("rows").alias("bucket_rows"))
    running = Window.partitionBy("stratum").orderBy("bucket")
    whole = Window.partitionBy("stratum")
    # A bucket belongs where the middle of its rows falls.
    middle = F.sum("bucket_rows").over(running) - F.col("bucket_rows") / F.lit(2.0)
    position = (middle / F.sum("bucket_rows").over(whole)).alias("position")
    target = F.lit(shares[-1][0])
    ends = [sum(share for _, share in shares[: i + 1]) for i in range(len(shares))]
    for (name, _), end in reversed(list(zip(shares[:-1], ends[:-1]))):
        target = F.when(F.col("position") < end, F.lit(name)).otherwise(target)
    placed = buckets.select("stratum", "bucket", position).select(
        "stratum", "bucket", target.alias("split")
    )
    return groups.join(F.broadcast(placed), ["stratum", "bucket"]).select(group_col, "rows", "split")


def assign_splits(
    records: DataFrame, groups: DataFrame, group_col: str = "server_slug", salt_from: str = "record_id"
) -> DataFrame:
    """Give every record the split of its group; the rows of a very large group are spread."""
    groups = materialize(groups)
    hot = hot_keys(groups, group_col, "rows")
    return salted_join(records, groups.select(group_col, "split"), group_col, hot, salt_from)


def stratified_group_folds(
    records: DataFrame,
    shares: Sequence[float],
    seed: int,
    group_col: str = "server_slug",
    label_col: str = "category",
    labels: Sequence[str] = LABELS,
) -> DataFrame:
    """``group, rows, fold``: every group lies in one fold, and every label is shared out alike.

    ``shares`` gives each fold's part of the rows (k equal numbers for k folds). Groups that weigh
    much, and buckets of the others, become vectors of their shares of every label and of all rows.
    From the heaviest on, each goes where the squared distance to the wanted shares then grows least.
    The vectors are bounded in number, whatever the number of groups. A null group is a group; rows
    without a label count as rows only; an empty table gives an empty result.
    """
    whole = sum(shares)
    wanted = [share / whole for share in shares]
    counts = [F.count_if(F.col(label_col) == label).alias(f"c{i}") for i, label in enumerate(labels)]
    parts = [f"c{i}" for i in range(len(labels))] + ["rows"]
    groups = materialize(records.groupBy(group_col).agg(*counts, F.count(F.lit(1)).alias("rows")))
    totals = groups.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in parts]).first()
    heavy = F.lit(False)
    for c in parts:
        if totals[c]:
            heavy = heavy | (F.col(c) * OWN_SHARE >= totals[c])
    name = F.coalesce(F.col(group_col).cast("string"), F.lit(""))
    by_label = F.array(*parts[:-1])
    stratum = F.when(F.array_max(by_label) == 0, F.lit(-1)).otherwise(argmax_id(by_label))
    bucket = F.concat_ws(":", stratum, F.substring(F.md5(F.concat(F.lit(str(seed)), name)), 1, FOLD_BUCKET_DIGITS))
    placed = groups.withColumn("_unit", F.when(heavy, F.concat(F.lit("="), name)).otherwise(bucket))
    units = placed.groupBy("_unit").agg(*[F.sum(c).alias(c) for c in parts]).collect()
    folds = _dealt(
        {u["_unit"]: [u[c] / totals[c] if totals[c] else 0.0 for c in parts] for u in units}, wanted, seed
    )
    # At most 256 * (labels + 1) heavy groups and as many buckets.
    table = records.sparkSession.createDataFrame(sorted(folds.items()), "_unit string, fold int")
    return placed.join(F.broadcast(table), "_unit").select(group_col, "rows", "fold")


def _dealt(units: dict[str, list[float]], wanted: Sequence[float], seed: int) -> dict[str, int]:
    """The fold of every unit; equal costs go to the first fold."""

    def order(unit: str) -> tuple[float, str]:
        return -sum(v * v for v in units[unit]), hashlib.md5(f"{seed}{unit}".encode()).hexdigest()

    held = [[0.0] * len(next(iter(units.values()), [])) for _ in wanted]
    out = {}
    for unit in sorted(units, key=order):
        vector = units[unit]
        costs = [
            sum(v * (2.0 * (c - share) + v) for v, c in zip(vector, own)) / share for share, own in zip(wanted, held)
        ]
        fold = costs.index(min(costs))
        held[fold] = [c + v for c, v in zip(held[fold], vector)]
        out[unit] = fold
    return out


def holdout_split(
    records: DataFrame,
    folds: Sequence[int] = (7, 6),
    seeds: Sequence[int] = (20260714, 20260715),
    names: Sequence[str] = ("test", "validation", "train"),
    group_col: str = "server_slug",
    label_col: str = "category",
    labels: Sequence[str] = LABELS,
) -> DataFrame:
    """``group, rows, split``: one of ``folds[0]`` folds is set apart, then one of ``folds[1]`` of the rest.

    Each step deals its groups anew with its own seed; what is left has the last name.
    """
    rest, out = records, None
    for n, seed, name in zip(folds, seeds, names):
        dealt = materialize(stratified_group_folds(rest, [1.0] * n, seed, group_col, label_col, labels))
        apart = dealt.filter("fold = 0").select(group_col, "rows", F.lit(name).alias("split"))
        out = apart if out is None else out.unionByName(apart)
        left = dealt.filter("fold <> 0").select(F.col(group_col).alias("_kept"))
        rest = rest.join(left, F.col(group_col).eqNullSafe(F.col("_kept")), "left_semi")
    return out.unionByName(dealt.filter("fold <> 0").select(group_col, "rows", F.lit(names[-1]).alias("split")))
