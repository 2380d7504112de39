"""Reading tables, folds and bounded training samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(id_col: str, folds: int, fold: int) -> Column:
    """Whether the id's CRC-32 falls into the fold that is never learnt from; null ids do."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(True))


def labelled_sample(
    docs: DataFrame, id_col: str, text_col: str, labels: DataFrame, label_col: str,
    max_rows: int, max_chars: int,
) -> list[tuple[str, object]]:
    """``(text, label)`` of at most ``max_rows`` labelled rows per label and ``max_chars`` in all.

    ``labels`` has ``id_col`` and ``label_col``. Rows are taken in the order of a hash of their
    id, whole texts only, so the sample is the same in every run. Only ids travel until the
    sample is fixed; it is the documented bound of what reaches the driver.
    """
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(label_col).alias("_label")
    ).groupBy("_id").agg(F.max("_label").alias("_label"))
    chosen = []
    for (label,) in known.select("_label").distinct().collect():
        rows = known.filter(F.col("_label") == F.lit(label)).orderBy(
            F.xxhash64(F.col("_id").cast("string")), "_id"
        ).limit(max_rows)
        chosen += [(r["_id"], r["_label"]) for r in rows.collect()]
    if not chosen:
        return []
    spark = docs.sparkSession
    schema = known.schema
    # At most max_rows ids per label.
    ids = F.broadcast(spark.createDataFrame(chosen, schema))
    own = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    found = own.join(ids, "_id")
    sizes = found.groupBy("_id").agg(F.max(F.length("_text")).alias("n"), F.max("_label").alias("_label"))
    ordered = sorted(
        sizes.select("_id", "n", "_label", F.xxhash64(F.col("_id").cast("string")).alias("h")).collect(),
        key=lambda r: (r["h"], str(r["_id"])),
    )
    kept, total = [], 0
    for r in ordered:
        if total + (r["n"] or 0) <= max_chars:
            total += r["n"] or 0
            kept.append((r["_id"], r["_label"]))
    if not kept:
        return []
    texts = own.join(F.broadcast(spark.createDataFrame(kept, schema)), "_id")
    rows = texts.groupBy("_id").agg(F.min("_text").alias("_text"), F.max("_label").alias("_label"))
    return [(r["_text"] or "", r["_label"]) for r in sorted(rows.collect(), key=lambda r: str(r["_id"]))]
