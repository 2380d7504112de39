"""The fixed label set and its small dimension table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The label set, in id order (id = position).
LABELS = ("Read", "Write", "Execute", "Destructive", "Financial", "Other")

# The split names, in report order.
SPLITS = ("train", "validation", "test")


def label_dim(spark: SparkSession, labels: Sequence[str] = LABELS) -> DataFrame:
    """``(label_id bigint, label string)``, one row per label.

    Its size is the length of ``labels``, so it is always safe to broadcast.
    """
    names = F.array(*[F.lit(label) for label in labels])
    return spark.range(1).select(F.posexplode(names).alias("label_id", "label")).select(
        F.col("label_id").cast("bigint"), "label"
    )


def label_id(label: Column, labels: Sequence[str] = LABELS) -> Column:
    """Label text to id; null when the text is not in the label set."""
    names = F.array(*[F.lit(name) for name in labels])
    position = F.array_position(names, label)
    return F.when(position > 0, position - 1).cast("bigint")


def label_name(id_col: Column, labels: Sequence[str] = LABELS) -> Column:
    """Id to label text; null for an id outside the set."""
    names = F.array(*[F.lit(name) for name in labels])
    return F.get(names, id_col.cast("int"))


def label_encode(df: DataFrame, label_col: str, id_col: str = "label_id") -> DataFrame:
    """Add ``id_col`` by a broadcast hash join with the label dimension."""
    dim = label_dim(df.sparkSession).select(
        F.col("label_id").alias(id_col), F.col("label").alias("_label")
    )
    return df.join(F.broadcast(dim), F.col(label_col) == F.col("_label"), "left").drop("_label")


def label_decode(df: DataFrame, id_col: str, label_col: str = "label") -> DataFrame:
    """Add ``label_col`` by a broadcast hash join with the label dimension."""
    dim = label_dim(df.sparkSession).select(
        F.col("label_id").alias("_id"), F.col("label").alias(label_col)
    )
    return df.join(F.broadcast(dim), F.col(id_col) == F.col("_id"), "left").drop("_id")
