"""One CSV from many tasks, and counts taken while predictions are written."""

import csv
import os

import pytest
from pyspark.sql import functions as F

from assayer.operators import records as R
from assayer.plans import jobs
from assayer.sinks import files

ODD = ['plain', 'a,b', 'say "x"', "two\r\nlines", "one\nline", "", None, "ü"]


def _read(folder):
    names = os.listdir(folder)
    assert sorted(n for n in names if not n.startswith(".")) == ["_SUCCESS", "part-00000.txt"]
    with open(os.path.join(folder, "part-00000.txt"), newline="") as f:
        return f.read()


@pytest.mark.parametrize("order", ["ordinal", None])
@pytest.mark.parametrize("tasks", [1, 9])
def test_one_header_quoting_and_line_ends_over_many_tasks(spark, tmp_path, order, tasks):
    rows = [(i, f"r{i}" if i >= len(ODD) else ODD[i], "Read") for i in range(500)]
    df = spark.createDataFrame(rows, "ordinal int, record_id string, category string").repartition(tasks)
    out = tmp_path / "out"
    out.mkdir()
    (out / "part-00007.txt").write_text("old")
    files.write_predictions_csv(df, str(out), order, single_file=True)
    text = _read(out)
    assert text.count("record_id,category\r\n") == 1 and text.startswith("record_id,category\r\n") and text.endswith("\r\n")
    got = [tuple(r) for r in csv.reader(text.splitlines(keepends=True))][1:]
    want = [(r[1] or "", r[2]) for r in rows]
    assert got == want if order else sorted(got) == sorted(want)


def test_an_empty_table_is_a_header(spark, tmp_path):
    df = spark.createDataFrame([], "ordinal int, record_id string, category string")
    files.write_predictions_csv(df, str(tmp_path / "out"), "ordinal", single_file=True)
    assert _read(tmp_path / "out") == "record_id,category\r\n"


def test_parts_are_streamed_where_a_file_system_neither_concatenates_nor_is_a_folder(spark, tmp_path, monkeypatch):
    """The way for other stores, tried on viewfs, which has no concat for local files."""
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.csv.link./out", f"file://{tmp_path}")
    rows = [(i, f"r{i}", "Read") for i in range(300)]
    df = spark.createDataFrame(rows, "ordinal int, record_id string, category string").repartition(5)
    files.write_predictions_csv(df, "viewfs://csv/out/x", "ordinal", single_file=True)
    assert _read(tmp_path / "x").split("\r\n")[1:-1] == [f"r{i},Read" for i in range(300)]


def test_rows_are_counted_in_the_write(spark):
    rows = [(i, f"r{i}", "Read" if i % 50 else ("Maybe" if i else None)) for i in range(400)]
    df = spark.createDataFrame(rows, "ordinal int, record_id string, category string").repartition(6)
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(x):
        calls.add(1)
        return x

    good = df.filter("ordinal % 50 <> 0").withColumn("category", seen.asNondeterministic()("category"))
    kept, n = R.checked_predictions(good, "category")
    assert n == 392 and kept.count() == 392 and calls.value == 392  # scored once
    with pytest.raises(R.InvalidPredictions) as wrong:
        R.checked_predictions(df, "category")
    assert wrong.value.n == 8 and wrong.value.first == [("r0", None), *[(f"r{i}", "Maybe") for i in (50, 100, 150, 200)]]


def test_every_scoring_path_reports_number_and_samples(spark):
    rows = [(i, f"r{i}", "n", "d", "{}") for i in range(9)]
    df = spark.createDataFrame(rows, "ordinal int, record_id string, name string, description string, input_schema string")
    bad = lambda t: t.withColumn("predicted_category", F.lit("Maybe"))
    with pytest.raises(ValueError, match=r"9 predictions outside the label set, first: \[\('r0', 'Maybe'\)"):
        jobs.predict_records(df, bad)
