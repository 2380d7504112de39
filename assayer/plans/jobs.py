"""Whole jobs: audit, train and evaluate, predict, error analysis."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.labels import LABELS, SPLITS
from assayer.operators import audit, errors, metrics
from assayer.operators.model import ModelConfig, fit_classifier, predict, vocabulary_size
from assayer.operators.records import (
    InvalidPredictions,
    checked_predictions,
    labelled,
    with_correct,
    with_input_text,
)
from assayer.session import materialize
from assayer.sinks import files


def audit_document(records: DataFrame, servers: DataFrame, splits: Sequence[str] = SPLITS) -> DataFrame:
    """The audit summary as one nested row. Keys and hashes stay distributed.

    The row holds known splits and labels only, so its size is fixed; labelled rows whose
    category is no label are counted in ``outside_label_set`` and listed by ``label_counts``.
    """
    known = records.filter(F.col("split").isin(*splits))
    # One scan hashes every text; all counters, duplicates and overlaps come from its narrow rows.
    narrow = materialize(audit.audit_columns(known))
    facts = {key: materialize(audit.key_facts(narrow, key, splits)) for key in ("server_slug", "content")}
    per_split = audit.audit_rows(narrow, splits, facts["server_slug"], facts["content"])
    is_label = F.col("category").isin(*LABELS)
    counted = audit.label_counts(known).groupBy("split")
    labels = counted.agg(
        F.map_from_entries(F.collect_list(F.when(is_label, F.struct("category", "n")))).alias("label_counts"),
        F.coalesce(F.sum(F.when(~is_label, F.col("n"))), F.lit(0)).alias("outside_label_set"),
    )
    # At most one row per split on both sides.
    joined = per_split.join(F.broadcast(labels), "split", "left")
    spans = {
        m: F.struct(*[F.col(f"{m}_{s}").alias(s) for s in ("min", "max", "mean")])
        for m in ("description_chars", "input_text_chars")
    }
    row = F.struct(
        "rows", "servers", F.coalesce("label_counts", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>"))).alias("label_counts"),
        F.coalesce("outside_label_set", F.lit(0)).alias("outside_label_set"), "missing_name", "missing_description", "empty_schema",
        "unparsable_schema", "duplicate_record_ids",
        F.col("exact_duplicates").alias("exact_name_description_duplicates"),
        spans["description_chars"].alias("description_char_length"),
        spans["input_text_chars"].alias("input_text_char_length"),
    )
    summary = joined.agg(F.map_from_entries(F.collect_list(F.struct("split", row))).alias("splits"))

    def as_map(key: str, name: str) -> DataFrame:
        return facts[key].select(F.map_from_entries("shared").alias(name))

    groups, content = as_map("server_slug", "server_slug_overlap"), as_map("content", "content_overlap")
    scan = audit.label_word_scan(servers)
    hits = audit.first_hits(servers).agg(
        F.sort_array(F.collect_list(F.struct("ordinal", "slug", "matched"))).alias("h")
    ).select(
        F.transform("h", lambda h: F.struct(h["slug"].alias("slug"), h["matched"].alias("matched_terms"))).alias("examples")
    )
    # One row each.
    one = F.lit(1).alias("_one")
    parts = [d.select("*", one) for d in (summary, groups, content, scan, hits)]
    doc = parts[0]
    for part in parts[1:]:
        doc = doc.join(part, "_one")
    return doc.select(
        "splits",
        F.struct("server_slug_overlap", "content_overlap").alias("cross_split_leakage"),
        F.struct("rows_scanned", "rows_with_label_word", "examples").alias("server_label_word_scan"),
    )


def evaluate(scored: DataFrame, true_col: str = "category", pred_col: str = "predicted_category") -> DataFrame:
    """One nested row with every metric, from one scan."""
    return metrics.report(metrics.tally(scored, true_col, pred_col))


def scored_records(records: DataFrame, pred_col: str = "predicted_category") -> DataFrame:
    """The layout of the scored-records file, with ``ordinal`` for the error analysis."""
    flagged = with_correct(records, "category", pred_col)
    return flagged.select(
        "ordinal", "record_id", "server_slug", "name", "description",
        F.col("category").alias("true_category"), F.col(pred_col).alias("predicted_category"), "correct",
    )


def train_and_evaluate(
    records: DataFrame, model_path: str, report_path: str, config: ModelConfig = ModelConfig(),
    scored_path: str | None = None,
) -> tuple[PipelineModel, DataFrame]:
    """Fit on the train split, save the model, score validation, write the metrics.

    The metrics hold the facts of the model, too. With ``scored_path`` the scored validation
    records are written as JSON lines, from which the error analysis starts.
    """
    texts = with_input_text(labelled(records)).withColumnRenamed("input_text", "text")
    start = time.perf_counter()
    model = fit_classifier(texts.filter(F.col("split") == "train"), config=config)
    seconds = time.perf_counter() - start
    model.write().overwrite().save(model_path)
    scored = predict(model, texts.filter(F.col("split") == "validation"))
    size = files.artifact_size_mb(records.sparkSession, model_path).first()["size_mb"]
    facts = F.struct(
        F.lit("TF-IDF (1-2 grams) + logistic regression").alias("type"),
        F.lit(vocabulary_size(model)).cast("bigint").alias("vocabulary_size"),
        F.lit(round(seconds, 2)).alias("train_seconds"),
        F.lit(float(size)).alias("size_mb"),
    )
    document = metrics.metrics_document(evaluate(scored)).withColumn("model", facts)
    files.write_report_json(document, report_path)
    if scored_path is not None:
        files.write_scored_jsonl(scored_records(scored), scored_path)
    return model, scored


def _scored(records: DataFrame, score: Callable[[DataFrame], DataFrame], labels: Sequence[str]) -> tuple[DataFrame, int]:
    """``ordinal, record_id, category`` of every record, checkpointed and checked, and their number."""
    if records.isEmpty():
        raise ValueError("no records to score")
    texts = with_input_text(records).select("ordinal", "record_id", F.col("input_text").alias("text"))
    scored = score(texts).select("ordinal", "record_id", F.col("predicted_category").alias("category"))
    return checked_predictions(scored, "category", labels=labels)


def predict_records(
    records: DataFrame, score: Callable[[DataFrame], DataFrame], labels: Sequence[str] = LABELS
) -> DataFrame:
    """``ordinal, record_id, category`` for every record; empty input is an error.

    ``score`` adds ``predicted_category`` to a table with a ``text`` column. The few scored columns
    are checkpointed; predictions outside the label set are counted on the way and are an
    error that names their number and the first five.
    """
    try:
        return _scored(records, score, labels)[0]
    except InvalidPredictions as wrong:
        raise ValueError(f"prediction outside the label set: {wrong.first[0][1]} ({wrong})") from wrong


def predict_to_csv(
    records: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    path: str,
    in_input_order: bool = True,
    single_file: bool = False,
    labels: Sequence[str] = LABELS,
) -> dict[str, float]:
    """Score and write; returns rows, seconds and rows per second.

    The few scored columns are checkpointed first, since sorting samples its input and must not run
    the model again; rows and predictions outside the label set are counted while that is
    written. In input order, the default, part files follow the input by name; each has
    its own header, as Spark's writers have. ``single_file`` gives one valid CSV, whose parts are
    written by many tasks and joined after that.
    """
    start = time.perf_counter()
    scored, rows = _scored(records, score, labels)
    order = "ordinal" if in_input_order else None
    files.write_predictions_csv(scored, path, order, single_file)
    seconds = time.perf_counter() - start
    return {"rows": rows, "seconds": seconds, "rows_per_second": rows / seconds}


def error_analysis(scored: DataFrame, path: str, top_pairs: int = 10, examples_per_pair: int = 6) -> DataFrame:
    """Write the grouped examples and return the top pairs."""
    files.write_report_json(errors.examples_document(scored, top_pairs, examples_per_pair), path)
    return errors.top_pairs(scored, top_pairs)
