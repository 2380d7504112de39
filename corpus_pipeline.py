"""Corpus pipeline: toxicity, line dedup, near-dedup, decontamination, token ids.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept. All but
the last return the columns of ``docs``. Null texts are kept by every filter; an empty table
passes through all stages.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.llm import decontaminate, linededup, simhash, toxicity
from assayer.llm.bpe import BpeCodec
from assayer.llm.catalog import tokenizer_path, toxicity_model
from assayer.llm.tables import table
from assayer.session import ensure_checkpoint_dir, materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go. The model learns from ``labels``, but for the held-out fold."""
    model = toxicity_model(spark, sf_dir)
    return docs.filter(toxicity.toxicity_score(model, F.col("text")) < 0.5)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every line that repeats an earlier one is taken out; ``n_chars`` follows the text."""
    cleaned = linededup.dedup_lines(docs, config=linededup.SIMHASH)
    if "n_chars" not in docs.columns:
        return cleaned
    kind = docs.schema["n_chars"].dataType
    return cleaned.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group linked by SimHash the document with the least id stays.

    Null ids come last: such a document stays only in a group without another id. Of repeated
    rows one stays. Groups are told apart by their fingerprints, so that documents of several
    groups with one id, or without an id, all stay.
    """
    others = [f.name for f in docs.schema if f.name not in ("doc_id", "text") and not isinstance(f.dataType, T.MapType)]
    key = F.struct(
        F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"),
        F.xxhash64(F.lit(0), *[F.col(f"`{c}`") for c in others]).alias("o"),
    )
    named = docs.withColumn("_key", key)
    heads = materialize(simhash.component_heads(named, "_key", shingle=3, distance=3))
    kept = named.join(heads.filter("n = 1").select("_key"), "_key", "left_semi")
    repeated = named.join(heads.filter("n > 1").select("_key"), "_key", "left_semi").dropDuplicates(["_key"])
    return kept.unionByName(repeated).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover half of a benchmark item or more go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def to_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids, n_tokens, decoded_sha256``: token ids and a digest of their decoded text."""
    codec = BpeCodec.build(docs, "text", tokenizer_path())
    again = docs.select("doc_id", codec.round_trip(F.col("text")).alias("_r")).select("doc_id", "_r.ids", "_r.decoded")
    return again.select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", to_ids),
]

# Hashes, edit distances and trained models are not SQL's; the tests check run() by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
