"""One query per operator. Each takes ``(spark, sf_dir)`` and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.catalog import views as V
from assayer.functions import numeric as N
from assayer.functions import params as P
from assayer.functions import text as X
from assayer.labels import label_decode, label_encode, label_id
from assayer.operators import audit, errors, metrics, overlap, selection, splitting, tfidf
from assayer.operators import records as R
from assayer.operators.model import ModelConfig, fit_classifier, fixed_validation_select, predict
from assayer.operators.scoring import batched_scorer
from assayer.plans import jobs
from assayer.session import materialize
from assayer.sources.records import normalize_records, union_splits

def _rec(spark, d):
    """The record table for queries that work on whole texts."""
    return V.spread(V.rec(spark, d))


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- sources, projections, predicates ---------------------------------------------------


@query
def load_records(spark, d):
    raw = V.rec(spark, d).select(
        "ordinal", "record_id", "server_slug", F.expr("nullif(name, '   ')").alias("name"),
        F.expr("nullif(description, '')").alias("description"),
        F.expr("nullif(input_schema, '')").alias("input_schema"), "category",
    )
    return normalize_records(raw)


@query
def labelled_filter(spark, d):
    return R.labelled(V.rec(spark, d)).select("record_id", "split", "category")


@query
def blank_predicate(spark, d):
    return V.rec(spark, d).select(
        "record_id",
        *[X.is_blank(F.col(c)).alias(f"blank_{c}") for c in ("name", "description", "input_schema")],
    )


@query
def json_object_predicate(spark, d):
    in_records = V.rec(spark, d).select(
        F.lit("record").alias("origin"), "record_id",
        F.coalesce(P.is_json_object("input_schema"), F.lit(False)).alias("is_object"),
        P.is_unparsable("input_schema").alias("is_unparsable"),
    )
    in_events = V.table(spark, d, "events").select(
        F.lit("event").alias("origin"), F.col("event_id").cast("string").alias("record_id"),
        F.coalesce(P.is_json_object("props"), F.lit(False)).alias("is_object"),
        P.is_unparsable("props").alias("is_unparsable"),
    )
    return in_records.unionByName(in_events)


@query
def correct_flag(spark, d):
    return R.with_correct(V.pred(spark, d), "category", "predicted_category").select(
        "record_id", "category", "predicted_category", "correct"
    )


@query
def error_filter(spark, d):
    return R.errors_only(correct_flag(spark, d)).drop("correct")


@query
def valid_label_guard(spark, d):
    return R.invalid_predictions(V.noisy(spark, d), "predicted_category").select(
        "record_id", "predicted_category"
    )


@query
def leakage_column_drop(spark, d):
    return R.model_input(_rec(spark, d), labelled_only=True)


@query
def label_encode_ids(spark, d):
    return label_encode(V.rec(spark, d), "category").select("record_id", "category", "label_id")


@query
def label_decode_ids(spark, d):
    ids = V.pred(spark, d).select("record_id", label_id(F.col("predicted_category")).alias("label_id"))
    return label_decode(ids, "label_id").select("record_id", "label_id", "label")


@query
def feature_projection(spark, d):
    return R.model_input(_rec(spark, d))


# --- text -------------------------------------------------------------------------------


@query
def whitespace_normalize(spark, d):
    return _rec(spark, d).select(
        "record_id", X.collapse_ws(F.col("description")).alias("description")
    )


@query
def norm_text(spark, d):
    return _rec(spark, d).select(
        "record_id", X.norm_text(F.col("name")).alias("name"),
        X.norm_text(F.col("description")).alias("description"),
    )


@query
def content_hash(spark, d):
    return R.with_content_hash(_rec(spark, d)).select("record_id", "content_hash")


@query
def truncate_chars(spark, d):
    return V.rec(spark, d).select(
        "record_id",
        *[
            X.truncate(F.col("description"), n).alias(f"first_{n}")
            for n in (X.DESCRIPTION_CHARS, X.EXAMPLE_DESCRIPTION_CHARS, X.PARAM_DESCRIPTION_CHARS)
        ],
    )


@query
def default_text(spark, d):
    return _rec(spark, d).select(
        "record_id", X.name_or_default(F.col("name")).alias("name"),
        X.description_or_default(F.col("description")).alias("description"),
    )


@query
def char_length(spark, d):
    return R.with_input_text(_rec(spark, d)).select(
        "record_id", X.char_length(F.col("description")).alias("description_chars"),
        X.char_length(F.col("input_text")).alias("input_text_chars"),
    )


@query
def label_word_match(spark, d):
    return R.label_word_hits(V.servers(spark, d)).select(
        "ordinal", "slug", F.array_join("matched", ",").alias("matched")
    )


@query
def pair_key(spark, d):
    return V.pred(spark, d).select(
        "record_id", X.pair_key(F.col("category"), F.col("predicted_category"), "to").alias("pair")
    )


@query
def input_text(spark, d):
    return R.with_input_text(_rec(spark, d)).select("record_id", "input_text")


# --- parameter table --------------------------------------------------------------------


def _params(spark, d):
    return R.params_table(_rec(spark, d))


@query
def params_explode(spark, d):
    declared = _params(spark, d).select(F.lit("record").alias("origin"), "record_id", "position", "param")
    props = V.table(spark, d, "events").select(
        F.col("event_id").cast("string").alias("record_id"),
        F.concat(F.lit('{"properties":'), F.col("props"), F.lit("}")).alias("input_schema"),
    )
    from_events = R.params_table(props).select(
        F.lit("event").alias("origin"), "record_id", "position", "param"
    )
    return declared.unionByName(from_events)


@query
def param_type_hint(spark, d):
    return _params(spark, d).select("record_id", "position", "is_object", "type_hint")


@query
def param_required(spark, d):
    return _params(spark, d).select("record_id", "position", "param", "required")


@query
def param_enum_preview(spark, d):
    parts = V.table(spark, d, "part").select(
        F.col("p_partkey").cast("string").alias("record_id"),
        F.concat(
            F.lit('{"properties":{"size":{"enum":["'), F.col("p_brand"), F.lit('","'),
            F.col("p_type"), F.lit('",'), F.col("p_size").cast("string"),
            F.lit(',null,false,1,2,3]}}}'),
        ).alias("input_schema"),
    )
    from_parts = R.params_table(parts).select(
        F.lit("part").alias("origin"), "record_id", "position", "enum_preview"
    )
    return (
        _params(spark, d)
        .select(F.lit("record").alias("origin"), "record_id", "position", "enum_preview")
        .unionByName(from_parts)
    )


@query
def param_description(spark, d):
    return _params(spark, d).select("record_id", "position", "param_description")


@query
def param_cap(spark, d):
    return R.shown_param_lines(_params(spark, d)).select(
        "record_id", "position", F.col("line").startswith("- ... and ").alias("is_overflow")
    )


@query
def param_line(spark, d):
    return R.shown_param_lines(_params(spark, d))


@query
def params_render(spark, d):
    return R.with_params_text(_rec(spark, d)).select("record_id", "params_text")


# --- numbers ----------------------------------------------------------------------------


@query
def share_pct(spark, d):
    counts = audit.label_counts(V.rec(spark, d))
    totals = counts.groupBy("split").agg(F.sum("n").alias("total"))
    # One row per split.
    return counts.join(F.broadcast(totals), "split").select(
        "split", "category", "n",
        N.round_half_even_1dp(N.share_pct(F.col("n"), F.col("total"))).alias("pct"),
    )


@query
def round_mean_1dp(spark, d):
    means = V.rec(spark, d).groupBy("server_slug").agg(
        (F.sum(F.length("description")).cast("double") / F.count(F.lit(1)).cast("double")).alias("mean")
    )
    return means.select("server_slug", N.round_half_even_1dp(F.col("mean")).alias("mean_1dp"))


@query
def power_dampen(spark, d):
    counts = V.rec(spark, d).groupBy("server_slug").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(
        "server_slug",
        *[
            F.round(N.dampen(F.col("n").cast("double"), p), 6).alias(f"pow_{name}")
            for p, name in ((0.0, "0"), (0.5, "half"), (1.0, "1"))
        ],
    )


# --- joins and set operations -----------------------------------------------------------


@query
def attach_predictions(spark, d):
    predictions = V.noisy(spark, d).select("record_id", "predicted_category")
    records = V.rec(spark, d).select("record_id", "server_slug", "category")
    return R.attach_predictions(records, predictions)


@query
def split_pairs(spark, d):
    return overlap.split_pairs(V.rec(spark, d))


@query
def group_overlap(spark, d):
    return overlap.overlap_counts(V.rec(spark, d), "server_slug")


@query
def content_overlap(spark, d):
    return overlap.overlap_counts(R.with_content_hash(_rec(spark, d)), "content_hash")


@query
def lookalike_rows(spark, d):
    hashed = materialize(
        R.with_content_hash(_rec(spark, d)).select("ordinal", "record_id", "split", "content_hash")
    )
    return overlap.mark_lookalikes(hashed, "content_hash").select("record_id", "split", "lookalike")


@query
def label_lookup(spark, d):
    return label_encode(V.pred(spark, d), "predicted_category").select("record_id", "label_id")


@query
def union_splits_rows(spark, d):
    rows = V.rec(spark, d)
    parts = {s: rows.filter(F.col("split") == s).drop("split") for s in ("train", "validation")}
    parts["test"] = rows.filter(F.col("split") == "test").drop("split", "category")
    return union_splits(parts).select("record_id", "split", "server_slug", "category")


@query
def group_intersect(spark, d):
    """Shared groups, with a second split drawn over the same table so that some are shared."""
    redrawn = V.rec(spark, d).withColumn(
        "split", F.expr("case when ordinal % 3 = 0 then 'train' else split end")
    )
    return overlap.shared_keys(redrawn, "server_slug")


@query
def content_intersect(spark, d):
    return overlap.shared_keys(R.with_content_hash(_rec(spark, d)), "content_hash")


@query
def distinct_keys(spark, d):
    return R.with_content_hash(_rec(spark, d)).select("split", "content_hash").distinct()


# --- audit ------------------------------------------------------------------------------


@query
def split_rows(spark, d):
    return audit.split_rows(V.rec(spark, d))


@query
def label_counts(spark, d):
    return audit.label_counts(V.rec(spark, d))


@query
def missing_counts(spark, d):
    return audit.missing_counts(V.rec(spark, d))


@query
def unparsable_count(spark, d):
    return audit.unparsable_counts(V.rec(spark, d))


@query
def duplicate_ids(spark, d):
    """Ids made from the text length, so that some repeat."""
    rows = V.rec(spark, d).withColumn("record_id", F.length("description").cast("string"))
    return audit.duplicate_ids(rows)


@query
def exact_duplicates(spark, d):
    return audit.exact_duplicates(_rec(spark, d))


@query
def distinct_groups(spark, d):
    return audit.distinct_groups(V.rec(spark, d))


@query
def length_stats(spark, d):
    lengths = R.with_input_text(_rec(spark, d)).select(
        "split", X.char_length(F.col("description")).alias("description_chars"),
        X.char_length(F.col("input_text")).alias("input_text_chars"),
    )
    stats = audit.length_stats(lengths, ["description_chars", "input_text_chars"])
    return _round(stats, "description_chars_mean", "input_text_chars_mean")


@query
def audit_split(spark, d):
    stats = audit.audit_splits(_rec(spark, d))
    return _round(stats, "description_chars_mean", "input_text_chars_mean")


@query
def label_share(spark, d):
    return audit.label_share(V.rec(spark, d))


@query
def imbalance_ratio(spark, d):
    return _round(audit.imbalance_ratio(V.rec(spark, d)), "imbalance_ratio")


@query
def rare_share(spark, d):
    return _round(audit.rare_share(V.rec(spark, d)), "rare_pct")


@query
def label_word_scan(spark, d):
    return audit.label_word_scan(V.servers(spark, d))


@query
def first_hits(spark, d):
    return audit.first_hits(V.servers(spark, d)).select(
        "ordinal", "slug", F.array_join("matched", ",").alias("matched")
    )


@query
def sorted_groups(spark, d):
    return audit.sorted_groups(V.rec(spark, d))


def _lengths(spark, d):
    texts = R.with_input_text(_rec(spark, d))
    words = F.size(F.regexp_extract_all(F.lower("description"), F.lit(r"[a-z0-9_]{2,}"), F.lit(0)))
    measures = [("input_text_chars", X.char_length(F.col("input_text")), 900), ("description_words", words.cast("bigint"), 320)]
    cells = F.array(
        *[F.struct(F.lit(m).alias("measure"), n.alias("n"), F.lit(limit).alias("limit")) for m, n, limit in measures]
    )
    return texts.select("split", F.explode(cells).alias("c")).select("split", "c.*")


@query
def length_percentiles(spark, d):
    lengths = _lengths(spark, d)
    return _round(audit.length_percentiles(lengths, "n", F.col("limit"), by=["measure"]), "p95", "p99", "share_within")


@query
def length_sketch(spark, d):
    """Sketches of every split merged; whether the ranks of their percentiles are within the stated error."""
    lengths = materialize(_lengths(spark, d))
    states = audit.length_sketches(lengths, "n", F.col("limit"), by=["split", "measure"])
    found = materialize(audit.sketched_percentiles(states, by=["measure"]))
    # One row per measure.
    shown = F.broadcast(found.withColumnRenamed("rows", "total"))
    error = F.lit(audit.rank_error())

    def near(p: str, q: float):
        below, upto = F.count_if(F.col("n") < F.col(p)), F.count_if(F.col("n") <= F.col(p))
        total = F.max("total")
        return ((below / total <= q + error) & (upto / total >= q - error)).alias(f"{p}_near")

    return _round(lengths.join(shown, "measure").groupBy("measure").agg(
        F.max("total").alias("rows"), F.max("share_within").alias("share_within"), near("p95", 0.95), near("p99", 0.99)
    ), "share_within")


# --- metrics ----------------------------------------------------------------------------


def _report(spark, d):
    return jobs.evaluate(V.pred(spark, d))


def _round(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


@query
def confusion_matrix(spark, d):
    return metrics.confusion_matrix(_report(spark, d))


@query
def per_class_metrics(spark, d):
    scores = metrics.per_class(_report(spark, d)).drop("predicted")
    return _round(scores, "precision", "recall", "f1")


@query
def accuracy(spark, d):
    return _round(_report(spark, d).select("n_samples", "accuracy"), "accuracy")


@query
def macro_f1(spark, d):
    return _round(_report(spark, d).select("macro_f1"), "macro_f1")


@query
def weighted_f1(spark, d):
    return _round(_report(spark, d).select("weighted_f1"), "weighted_f1")


@query
def macro_f1_present(spark, d):
    return _round(_report(spark, d).select("macro_f1_present"), "macro_f1_present")


@query
def eval_report(spark, d):
    """Predictions that are sometimes no label: they count in accuracy, not in the matrix."""
    full = jobs.evaluate(R.labelled(V.noisy(spark, d)))
    scalars = ("accuracy", "macro_f1", "weighted_f1")
    flat = full.select(
        "n_samples", *scalars, F.expr("aggregate(flatten(matrix), 0L, (a, x) -> a + x)").alias("in_matrix")
    )
    return _round(flat, *scalars)


@query
def class_weights(spark, d):
    train = V.rec(spark, d).filter(F.col("split") == "train")
    return _round(metrics.class_weights(train, (0.0, 0.5, 1.0)), "weight")


@query
def balanced_weights(spark, d):
    train = V.rec(spark, d).filter(F.col("split") == "train")
    return _round(metrics.balanced_weights(train), "weight")


@query
def confusion_pairs(spark, d):
    return errors.confusion_pairs(jobs.scored_records(V.pred(spark, d)))


@query
def error_rate(spark, d):
    return _round(errors.error_rate(jobs.scored_records(V.pred(spark, d))), "error_pct")


@query
def invalid_rate(spark, d):
    return _round(metrics.invalid_rate(V.noisy(spark, d), "predicted_category"), "invalid_rate")


def _by_score(spark, d):
    best = R.argmax_id(F.col("scores"))
    return V.scores(spark, d).withColumn("label_id", best)


@query
def model_compare(spark, d):
    """The one-word rule against the word-count scores."""
    rule = V.pred(spark, d).select("category", "predicted_category", F.lit("rule").alias("model"))
    counted = label_decode(R.labelled(_by_score(spark, d)), "label_id", "predicted_category").select(
        "category", "predicted_category", F.lit("counts").alias("model")
    )
    both = rule.unionByName(counted)
    out = metrics.compare_models(both, "category", "predicted_category", "model", ["rule", "counts"])
    return _round(out, "rule", "counts", "gap")


# --- order-dependent --------------------------------------------------------------------


@query
def top_pairs(spark, d):
    return errors.top_pairs(jobs.scored_records(V.pred(spark, d)))


@query
def pair_examples(spark, d):
    return errors.pair_examples(jobs.scored_records(V.pred(spark, d)))


@query
def head_sample(spark, d):
    return R.first_rows(V.rec(spark, d).select("ordinal", "record_id", "category"), 100)


@query
def argmax_label(spark, d):
    return _by_score(spark, d).select("record_id", "label_id")


@query
def best_epoch(spark, d):
    return _round(selection.best_epoch(V.epochs(spark, d)), "best_macro_f1")


@query
def early_stop_epoch(spark, d):
    return selection.early_stop_epoch(V.epochs(spark, d), patience=3)


# --- features, training, scoring --------------------------------------------------------


def _docs(spark, d):
    """Whole texts."""
    docs = V.table(spark, d, "documents").select(F.col("doc_id").alias("record_id"), "text")
    return V.spread(docs)


@query
def tokens(spark, d):
    from assayer.functions.terms import tokens as token_array

    cut = _docs(spark, d).select("record_id", token_array(F.col("text")).alias("t"))
    return cut.select(
        "record_id", F.size("t").cast("bigint").alias("n_tokens"), F.array_join("t", " ").alias("tokens")
    )


@query
def ngrams_1_2(spark, d):
    cut = tfidf.with_terms(_docs(spark, d), "text")
    return cut.select(
        "record_id", F.size("terms").cast("bigint").alias("n_terms"),
        F.array_join("terms", "|").alias("terms"),
    )


@query
def doc_freq(spark, d):
    return tfidf.doc_freq(_docs(spark, d), "text")


@query
def vocab_prune(spark, d):
    docs = _docs(spark, d)
    return _round(tfidf.prune_vocabulary(tfidf.doc_freq(docs, "text"), docs), "idf")


@query
def tfidf_weights(spark, d):
    weights = tfidf.tfidf(_docs(spark, d), "record_id", "text")
    return _round(weights, "idf", "tfidf")


def _texts(spark, d):
    return R.with_input_text(_rec(spark, d)).withColumnRenamed("input_text", "text")


def train_model(spark, d):
    return fit_classifier(R.labelled(_texts(spark, d)).filter(F.col("split") == "train"))


@query
def logreg_train(spark, d):
    """Train, then score the validation split: the metrics of the fitted model."""
    model = train_model(spark, d)
    held_out = _texts(spark, d).filter(F.col("split") == "validation")
    full = jobs.evaluate(predict(model, held_out))
    return full.select("n_samples", "accuracy", "macro_f1", "weighted_f1")


@query
def logreg_predict(spark, d):
    return predict(train_model(spark, d), _texts(spark, d)).select("record_id", "split", "predicted_category")


def _word_scorer():
    """A small user-supplied scorer: how often each label's word occurs."""
    words = V.SCORE_WORDS

    # Nested, so that it is shipped by value.
    def load():
        def score(texts):
            return np.array([[t.count(w) for w in words] for t in map(str.lower, texts)], dtype=float)

        return score

    return load


@query
def batched_scorer_labels(spark, d):
    return batched_scorer(_docs(spark, d), "text", _word_scorer())


@query
def predict_job(spark, d):
    score = lambda texts: batched_scorer(texts, "text", _word_scorer())
    return jobs.predict_records(_rec(spark, d), score).drop("ordinal")


@query
def fixed_validation_select_c(spark, d):
    rows = R.labelled(_texts(spark, d))
    _, table = fixed_validation_select(
        rows.filter(F.col("split") == "train"),
        rows.filter(F.col("split") == "validation"),
        [ModelConfig(c=4.0), ModelConfig(c=0.25)],
    )
    return table


@query
def group_stratified_split(spark, d):
    shares = [("train", 0.7), ("validation", 0.15), ("test", 0.15)]
    records = V.rec(spark, d)
    groups = splitting.group_stratified_split(records, shares, seed=20260801)
    assigned = splitting.assign_splits(
        records.select("record_id", "server_slug", "category"), groups
    )
    return assigned.groupBy("server_slug", "split").agg(F.count(F.lit(1)).alias("rows"))


@query
def group_stratified_folds(spark, d):
    return splitting.stratified_group_folds(V.rec(spark, d), [1.0] * 5, seed=20260714)


# Operator names that would clash with functions in this module.
for _name, _key in {
    "label_encode_ids": "label_encode",
    "label_decode_ids": "label_decode",
    "union_splits_rows": "union_splits",
    "tfidf_weights": "tfidf",
    "batched_scorer_labels": "batched_scorer",
    "fixed_validation_select_c": "fixed_validation_select",
}.items():
    QUERIES[_key] = QUERIES.pop(_name)
