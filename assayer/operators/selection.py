"""Choosing an epoch or a model by macro F1."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def best_epoch(epochs: DataFrame) -> DataFrame:
    """Per run the epoch with the highest macro F1, the earliest of equals."""
    rank = F.struct(F.col("macro_f1"), -F.col("epoch"))
    return epochs.groupBy("run").agg(
        F.max_by("epoch", rank).alias("best_epoch"), F.max("macro_f1").alias("best_macro_f1")
    )


def early_stop_epoch(epochs: DataFrame, patience: int) -> DataFrame:
    """Per run the epoch after which training stops.

    An evaluation counts as better only when it beats all earlier ones. The run stops at
    the first one that is ``patience`` evaluations past the last better one, or at its end.
    """
    order = Window.partitionBy("run").orderBy("epoch")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    best_before = F.max("macro_f1").over(before)
    seen = epochs.select(
        "run", "epoch", "macro_f1",
        F.row_number().over(order).alias("step"),
        (best_before.isNull() | (F.col("macro_f1") > best_before)).alias("better"),
    )
    waited = F.col("step") - F.max(F.when(F.col("better"), F.col("step"))).over(so_far)
    return (
        seen.withColumn("waited", waited)
        .groupBy("run")
        .agg(
            F.min(F.when(F.col("waited") >= patience, F.col("epoch"))).alias("hit"),
            F.max("epoch").alias("last"),
        )
        .select(
            "run",
            F.coalesce("hit", "last").alias("stop_epoch"),
            F.col("hit").isNotNull().alias("stopped_early"),
        )
    )
