"""Row-level operators over the record table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from assayer.functions import params as P
from assayer.functions import text as X
from assayer.labels import LABELS, label_dim, label_encode
from assayer.session import keep_last_of_repeated_keys, materialize

# Columns that tell which group a record came from; no model may see them.
GROUP_COLUMNS = ("server_slug", "slug", "server_name", "server_description")


def labelled(records: DataFrame) -> DataFrame:
    return records.filter(F.col("category").isNotNull())


def with_correct(scored: DataFrame, true_col: str, pred_col: str) -> DataFrame:
    """Add ``correct``; a labelled row without a prediction is wrong, an unlabelled one is null."""
    hit = F.col(pred_col).eqNullSafe(F.col(true_col))
    return scored.withColumn("correct", F.when(F.col(true_col).isNotNull(), hit))


def is_error() -> Column:
    """Whatever is not known to be correct."""
    return ~F.coalesce("correct", F.lit(False))


def errors_only(scored: DataFrame) -> DataFrame:
    return scored.filter(is_error())


def with_params_text(records: DataFrame) -> DataFrame:
    keep_last_of_repeated_keys(records.sparkSession)
    return records.withColumn("params_text", P.render_params("input_schema"))


def with_input_text(records: DataFrame) -> DataFrame:
    keep_last_of_repeated_keys(records.sparkSession)
    text = X.input_text(F.col("name"), F.col("description"), P.render_params("input_schema"))
    return records.withColumn("input_text", text)


def with_content_hash(records: DataFrame) -> DataFrame:
    return records.withColumn("content_hash", X.content_hash(F.col("name"), F.col("description")))


def params_table(records: DataFrame, keys: Sequence[str] = ("record_id",)) -> DataFrame:
    """One row per declared parameter, in document order, with its parts and shown line.

    ``position`` counts from 0 and is not capped; a record that is not a JSON object or
    declares nothing gives no rows.
    """
    keep_last_of_repeated_keys(records.sparkSession)
    parsed = records.select(*keys, P.parse_schema("input_schema").alias("_schema"))
    listed = parsed.select(
        *keys,
        P.property_entries("_schema").alias("_entries"),
        P.required_names("_schema").alias("_required"),
    )
    exploded = listed.select(
        *keys, "_required",
        F.size("_entries").cast("bigint").alias("n_params"),
        F.posexplode("_entries").alias("position", "_entry"),
    )
    parts = P.param_parts("_entry", "_required")
    described = exploded.select(
        *keys,
        F.col("position").cast("bigint").alias("position"),
        "n_params",
        F.col("_entry.key").alias("param"),
        parts["is_object"].alias("is_object"),
        parts["type_hint"].alias("type_hint"),
        parts["required"].alias("required"),
        parts["enum_preview"].alias("enum_preview"),
        parts["description"].alias("param_description"),
    )
    line = P.param_line("param", "required", "type_hint", "enum_preview", "param_description")
    return described.withColumn("line", line)


def shown_param_lines(params: DataFrame, keys: Sequence[str] = ("record_id",)) -> DataFrame:
    """The lines that are shown: the first twelve, then one that counts the rest."""
    first = params.filter(F.col("position") < P.MAX_PARAMS).select(*keys, "position", "line")
    rest = params.filter(F.col("position") == P.MAX_PARAMS).select(
        *keys, "position", P.overflow_line("n_params").alias("line")
    )
    return first.unionByName(rest)


def model_input(records: DataFrame, labelled_only: bool = False) -> DataFrame:
    """``record_id, text[, label_id]``: what a model may see. Group columns are dropped."""
    rows = with_input_text(labelled(records) if labelled_only else records)
    out = rows.select("record_id", F.col("input_text").alias("text"), "category")
    out = label_encode(out, "category") if labelled_only else out
    return refuse_group_columns(out.drop("category"))


def refuse_group_columns(features: DataFrame) -> DataFrame:
    """Fail while planning when a group column would reach an estimator."""
    leaked = [c for c in features.columns if c in GROUP_COLUMNS]
    if leaked:
        raise ValueError(f"group columns must not reach a model: {leaked}")
    return features


def invalid_predictions(scored: DataFrame, pred_col: str) -> DataFrame:
    """Rows whose prediction is outside the label set, by a broadcast anti join."""
    dim = label_dim(scored.sparkSession)
    return scored.join(F.broadcast(dim), F.col(pred_col) == F.col("label"), "left_anti")


class InvalidPredictions(ValueError):
    """Predictions outside the label set: how many, and the first of them as ``(record_id, prediction)``."""

    def __init__(self, n: int, first: list[tuple]):
        super().__init__(f"{n} predictions outside the label set, first: {first}")
        self.n, self.first = n, first


def checked_predictions(
    scored: DataFrame, pred_col: str, order_col: str = "ordinal", labels: Sequence[str] = LABELS, samples: int = 5
) -> tuple[DataFrame, int]:
    """``scored`` from a checkpoint, and its number of rows.

    Rows and predictions outside the label set are counted while the checkpoint is written, so a
    good table is never read again. With bad ones the job fails, and only then are the first
    ``samples`` of them looked up.
    """
    bad = ~F.coalesce(F.col(pred_col).isin(*labels), F.lit(False))
    seen = Observation()
    kept = materialize(
        scored.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("bad"))
    )
    if seen.get["bad"]:
        # At most ``samples`` rows reach the driver.
        first = kept.filter(bad).orderBy(order_col).limit(samples).collect()
        raise InvalidPredictions(seen.get["bad"], [(r["record_id"], r[pred_col]) for r in first])
    return kept, seen.get["rows"]


def argmax_id(scores: Column) -> Column:
    """Position of the highest score, ties to the lowest position."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("bigint")


def attach_predictions(records: DataFrame, predictions: DataFrame) -> DataFrame:
    """Join by ``record_id``, which both sides must hold, and hold once.

    An id that repeats, lacks a partner or is null fails the job while it runs: the sides are joined in
    full and the checks read the joined rows, in the shuffle of the join.
    """
    once = Window.partitionBy("record_id").orderBy("record_id")
    left = records.withColumn("_n", F.row_number().over(once))
    right = predictions.withColumnRenamed("record_id", "_id").withColumn("_in", F.lit(True))
    right = right.withColumn("_m", F.row_number().over(Window.partitionBy("_id").orderBy("_id")))
    joined = left.join(right, F.col("record_id") == F.col("_id"), "full")
    named = F.coalesce(F.col("record_id"), F.col("_id"), F.lit("null"))
    problem = (
        F.when((F.col("_n") > 1) | (F.col("_m") > 1), F.concat(F.lit("repeated record_id: "), named))
        .when(F.col("_in").isNull(), F.concat(F.lit("record without a prediction: "), named))
        .when(F.col("_n").isNull(), F.concat(F.lit("prediction without a record: "), named))
    )
    checked = F.when(problem.isNotNull(), F.raise_error(problem)).otherwise(F.lit(True))
    # The check is a filter, so no projection can prune it away.
    return joined.filter(checked).drop("_n", "_m", "_in", "_id")


def alignment(records: DataFrame, predictions: DataFrame) -> DataFrame:
    """Counts that must agree before predictions are attached.

    ``repeated`` is the number of ids that one side holds more than once and
    ``unmatched`` the number of ids that only one side holds.
    """
    sides = records.select("record_id", F.lit(1).alias("r"), F.lit(0).alias("p")).unionByName(
        predictions.select("record_id", F.lit(0).alias("r"), F.lit(1).alias("p"))
    )
    per_id = sides.groupBy("record_id").agg(F.sum("r").alias("r"), F.sum("p").alias("p"))
    return per_id.agg(
        F.coalesce(F.sum("r"), F.lit(0)).alias("records"),
        F.coalesce(F.sum("p"), F.lit(0)).alias("predictions"),
        F.count_if((F.col("r") > 1) | (F.col("p") > 1)).alias("repeated"),
        F.count_if((F.col("r") == 0) | (F.col("p") == 0)).alias("unmatched"),
    )


def first_rows(df: DataFrame, n: int, order_col: str = "ordinal") -> DataFrame:
    """The first ``n`` rows in file order, as a distributed top-k (no full sort)."""
    return df.orderBy(order_col).limit(n)


def label_word_hits(servers: DataFrame) -> DataFrame:
    """Add ``matched``: the label words that occur in name and description."""
    return servers.withColumn("matched", X.label_words_in(F.col("name"), F.col("description")))
