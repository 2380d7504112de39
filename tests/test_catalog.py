"""Every registered query against its SQL counterpart in DuckDB, and plan checks."""

import re

import compare
import pytest

import __spark_entry__ as entry_file
from pyspark.sql import functions as F
from assayer.catalog.oracle import ORACLE
from assayer.catalog.queries import QUERIES
from assayer.operators.model import fit_classifier, predict
from assayer.operators.tfidf import with_terms

SF_DIR = "/root/testdata/sf0.001"
NO_SQL = {"logreg_train", "logreg_predict", "fixed_validation_select"}


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_keys():
    assert set(QUERIES) - set(ORACLE) == NO_SQL
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert compare.differences(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(NO_SQL - {"fixed_validation_select"}))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry_file.entry(spark).count() == 3


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_are_pruned_and_filters_pushed(spark):
    counts = plan(QUERIES["split_rows"](spark, SF_DIR))
    assert re.search(r"ReadSchema: struct<source:string>", counts)
    assert "CartesianProduct" not in counts


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"fixed_validation_select"}))
def test_no_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text


def test_one_scan_audit(spark):
    text = plan(QUERIES["audit_split"](spark, SF_DIR))
    assert "FileScan parquet" not in text and "Expand" not in text  # all from the checkpointed narrow rows


def test_filters_pass_the_tokeniser(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    cut = with_terms(docs, "text").filter("doc_id = 5")
    assert "EqualTo(doc_id,5)" in plan(cut)


def test_filters_pass_the_model(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang")
    labelled = docs.withColumn("category", F.when(F.col("lang") == "en", "Read").otherwise("Write"))
    model = fit_classifier(labelled)
    assert "EqualTo(doc_id,5)" in plan(predict(model, docs).filter("doc_id = 5"))
