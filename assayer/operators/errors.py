"""Which mistakes are made most, and examples of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayer.functions.numeric import share_pct
from assayer.functions.text import EXAMPLE_DESCRIPTION_CHARS, pair_key, truncate
from assayer.operators.records import errors_only, is_error

_PAIR = ("true_category", "predicted_category")


def error_rate(scored: DataFrame) -> DataFrame:
    wrong = F.count_if(is_error())
    return scored.agg(
        F.count(F.lit(1)).alias("rows"),
        wrong.alias("errors"),
        share_pct(wrong, F.count(F.lit(1))).alias("error_pct"),
    )


def confusion_pairs(scored: DataFrame) -> DataFrame:
    """Every wrong (true, predicted) pair with its count and first appearance."""
    return errors_only(scored).groupBy(*_PAIR).agg(
        F.count(F.lit(1)).alias("n"), F.min("ordinal").alias("first_seen")
    )


def top_pairs(scored: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most frequent pairs; of equal counts the one seen first comes first."""
    ranked = confusion_pairs(scored).orderBy(F.desc("n"), "first_seen").limit(k)
    return ranked.select(pair_key(*[F.col(c) for c in _PAIR], "to").alias("pair"), *_PAIR, "n", "first_seen")


def pair_examples(scored: DataFrame, k: int = 10, n: int = 6) -> DataFrame:
    """The first ``n`` records of each top pair, in file order.

    Descriptions are cut before the shuffle, and Spark keeps at most ``n`` rows per pair
    and task ahead of it (WindowGroupLimit), so a pair with very many errors is cheap.
    """
    top = top_pairs(scored, k).select("pair")  # at most k rows
    narrow = errors_only(scored).select(
        "ordinal", "record_id", "server_slug", "name",
        truncate(F.col("description"), EXAMPLE_DESCRIPTION_CHARS).alias("description"),
        pair_key(*[F.col(c) for c in _PAIR], "to").alias("pair"),
    )
    order = Window.partitionBy("pair").orderBy("ordinal")
    return (
        narrow.join(F.broadcast(top), "pair", "inner")
        .withColumn("example_no", F.row_number().over(order))
        .filter(F.col("example_no") <= n)
        .withColumn("example_no", F.col("example_no").cast("bigint"))
    )


def examples_document(scored: DataFrame, k: int = 10, n: int = 6) -> DataFrame:
    """One row: a map from pair to its examples (at most ``k * n`` of them)."""
    fields = F.struct("example_no", "record_id", "server_slug", "name", "description")
    grouped = pair_examples(scored, k, n).groupBy("pair").agg(
        F.sort_array(F.collect_list(fields)).alias("rows")
    )
    shown = F.transform(
        "rows", lambda r: F.struct(*[r[c].alias(c) for c in ("record_id", "server_slug", "name", "description")])
    )
    entries = F.collect_list(F.struct("pair", shown.alias("examples")))
    return grouped.agg(F.map_from_entries(entries).alias("examples"))
