import math
import random

import pytest
from pyspark.sql import functions as F

from assayer.labels import LABELS
from assayer.operators import audit, errors, metrics, selection
from assayer.plans import jobs

# Published confusion matrices (rows: true, columns: predicted) with their scores.
STRONG = (
    [[2753, 50, 9, 3, 2, 0], [71, 1005, 2, 5, 3, 1], [25, 20, 190, 0, 0, 0],
     [4, 5, 2, 241, 1, 0], [0, 0, 1, 0, 21, 0], [10, 1, 0, 0, 0, 4]],
    0.9514563106796117, 0.829898972123399, 0.9504809800976998, 215,
)


def expand(spark, matrix):
    cells = [(LABELS[i], LABELS[j], n) for i, row in enumerate(matrix) for j, n in enumerate(row) if n]
    df = spark.createDataFrame(cells, "category string, predicted_category string, n int")
    return df.select("category", "predicted_category", F.explode(F.sequence(F.lit(1), "n")).alias("k"))


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "category string, predicted_category string")


def report(df):
    return metrics.report(metrics.tally(df, "category", "predicted_category"))


def test_published_matrix(spark):
    matrix, accuracy, macro, weighted, wrong = STRONG
    full = report(expand(spark, matrix)).first()
    assert math.isclose(full.accuracy, accuracy, abs_tol=1e-12)
    assert math.isclose(full.macro_f1, macro, abs_tol=1e-12)
    assert math.isclose(full.weighted_f1, weighted, abs_tol=1e-12)
    assert full.matrix == matrix
    assert full.n_samples - sum(matrix[i][i] for i in range(6)) == wrong


def test_order_and_partitions_do_not_matter(spark):
    rows = [(random.Random(i).choice(LABELS), random.Random(i * 7 + 1).choice([*LABELS, "x"])) for i in range(300)]
    seen = set()
    for parts, seed in ((1, 1), (3, 2), (7, 3)):
        shuffled = random.Random(seed).sample(rows, len(rows))
        full = report(scored(spark, shuffled).repartition(parts)).first()
        seen.add((full.accuracy, full.macro_f1, full.weighted_f1, str(full.matrix)))
    assert len(seen) == 1


def test_absent_labels_and_outside_predictions(spark):
    full = report(scored(spark, [("Read", "Read"), ("Read", "Maybe"), ("Write", "Read"), ("Odd", "Odd")])).first()
    by = {c.label: c for c in full.per_class}
    assert full.n_samples == 4 and full.accuracy == 0.5
    assert (by["Read"].precision, by["Read"].recall, by["Read"].support) == (0.5, 0.5, 2)
    assert by["Other"].f1 == 0.0 and by["Other"].support == 0
    assert math.isclose(full.macro_f1, 0.5 / 6) and math.isclose(full.macro_f1_present, 0.25)
    assert sum(map(sum, full.matrix)) == 2


def test_empty_input(spark):
    full = report(scored(spark, [])).first()
    assert (full.n_samples, full.accuracy, full.macro_f1, full.weighted_f1) == (0, 0.0, 0.0, 0.0)
    assert full.matrix == [[0] * 6] * 6
    assert errors.error_rate(scored(spark, []).withColumn("correct", F.lit(True))).first().error_pct is None


def test_class_weights(spark):
    # Published training counts and weights.
    counts = {"Read": 14084, "Write": 5433, "Execute": 1175, "Destructive": 1264, "Financial": 111, "Other": 76}
    want = {"Read": 0.511893, "Write": 0.824181, "Execute": 1.772245, "Destructive": 1.708713,
            "Financial": 5.766086, "Other": 6.968444}
    df = spark.createDataFrame(list(counts.items()), "category string, n int").select(
        "category", F.explode(F.sequence(F.lit(1), "n")).alias("k")
    )
    got = {r.label: r.weight for r in metrics.class_weights(df, (0.5,)).collect()}
    assert all(abs(got[k] - want[k]) < 1e-6 for k in want)
    full = {r.label: r.weight for r in metrics.balanced_weights(df).collect()}
    assert math.isclose(full["Other"] / full["Read"], 14084 / 76)
    records = df.withColumn("split", F.lit("train"))
    share = {r.label: (r.train_n, r.train_pct) for r in audit.label_share(records).collect()}
    assert [share[k][1] for k in LABELS] == [63.6, 24.5, 5.3, 5.7, 0.5, 0.3]
    assert round(audit.imbalance_ratio(records).first().imbalance_ratio) == 185


def test_weights_with_an_absent_label(spark):
    df = spark.createDataFrame([("Read",), ("Read",), ("Write",)], "category string")
    got = {(r.label, r.power): r.weight for r in metrics.class_weights(df, (0.0, 0.5, 1.0)).collect()}
    assert got["Other", 0.0] == 1.0
    assert math.isclose(got["Other", 1.0], 3 / 6) and math.isclose(got["Read", 0.5], (3 / 12) ** 0.5)
    assert {r.label for r in metrics.balanced_weights(df).collect()} == {"Read", "Write"}


def error_rows(spark, pairs):
    rows = [(i, str(i), "g", "n", "d" * 500, t, p) for i, (t, p) in enumerate(pairs)]
    df = spark.createDataFrame(
        rows, "ordinal bigint, record_id string, server_slug string, name string, description string,"
        " category string, predicted_category string",
    )
    return jobs.scored_records(df)


@pytest.mark.parametrize("swap", [False, True])
def test_ties_go_to_the_pair_seen_first(spark, swap):
    pairs = [("Read", "Write"), ("Write", "Read"), ("Write", "Read"), ("Read", "Write"), ("Other", "Read")]
    if swap:
        pairs = [(p, t) for t, p in pairs]
    top = [r.pair for r in errors.top_pairs(error_rows(spark, pairs), 2).orderBy(F.desc("n"), "first_seen").collect()]
    want = ["Read_to_Write", "Write_to_Read"]
    assert top == (want[::-1] if swap else want)


def test_pair_examples(spark):
    df = error_rows(spark, [("Read", "Write")] * 9 + [("Read", "Read")] * 3 + [("Write", "Read")] * 2)
    got = errors.pair_examples(df, k=1, n=6).collect()
    assert [r.ordinal for r in sorted(got, key=lambda r: r.example_no)] == list(range(6))
    assert all(len(r.description) == 400 for r in got)
    doc = errors.examples_document(df, k=10, n=6).first().examples
    assert {k: len(v) for k, v in doc.items()} == {"Read_to_Write": 6, "Write_to_Read": 2}
    plan = errors.pair_examples(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_epochs(spark):
    # Published history of one run, and one that never improves.
    history = [0.7087, 0.7820, 0.8048, 0.8299, 0.8287]
    rows = [("a", i, v) for i, v in enumerate(history, 1)]
    rows += [("flat", i, 0.5) for i in range(1, 8)] + [("tie", 1, 0.4), ("tie", 2, 0.6), ("tie", 3, 0.6)]
    df = spark.createDataFrame(rows, "run string, epoch bigint, macro_f1 double")
    assert {r.run: r.best_epoch for r in selection.best_epoch(df).collect()} == {"a": 4, "flat": 1, "tie": 2}
    stop = {r.run: (r.stop_epoch, r.stopped_early) for r in selection.early_stop_epoch(df, 2).collect()}
    assert stop == {"a": (5, False), "flat": (3, True), "tie": (3, False)}
    assert selection.early_stop_epoch(df.filter("run = 'a'"), 1).first().stop_epoch == 5
