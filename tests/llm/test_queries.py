"""Registered queries of the subpackage over the smallest tables, and their SQL counterparts."""

import compare
import pytest

import corpus_pipeline
from assayer.llm.catalog import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_every_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert compare.differences(QUERIES[name](spark, SF_DIR), compare.connect(SF_DIR), ORACLE[name]) == []


@pytest.mark.parametrize(
    "name, names",
    [
        ("op1_toxicity", ["doc_id", "held_out", "score", "predicted"]),
        ("op2_html_extraction", ["page_id", "url", "text", "n_chars"]),
        ("op3_sharding", ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]),
        ("op4_simhash_near_dedup", ["doc_id", "fingerprint", "component_id"]),
        ("op8_bpe", ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]),
        ("op10_language_id", ["doc_id", "held_out", "lang_pred", "score"]),
    ],
)
def test_contract_columns(spark, name, names):
    out = QUERIES[name](spark, SF_DIR)
    assert out.columns[: len(names)] == names
    source = "pages" if name.startswith("op2") else "documents"
    assert out.count() == spark.read.parquet(f"{SF_DIR}/{source}.parquet").count()


def test_line_dedup_stays_in_the_jvm(spark):
    plan = QUERIES["op7_line_dedup"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_pipeline_equals_its_stages_one_by_one(spark):
    """run() against the stages applied to plain Python rows, each with its own brute-force check."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    given = docs.columns
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        if name != "bpe":
            assert out.columns == given
            docs = spark.createDataFrame(out.collect(), docs.schema)
            rows[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    whole = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r["doc_id"] for r in whole} == set(rows["decontamination"])
    assert sorted(map(str, whole)) == sorted(map(str, out.collect()))
    seen = set()
    for _, text in sorted(rows["line_dedup"].items()):
        for line in text.split("\n"):
            assert not line.strip() or line not in seen
            seen.add(line)


def test_pipeline_of_nothing(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert docs.count() == 0


def test_stages_keep_nulls_and_foreign_columns(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, ids string, score string, line int"
    rows = [
        (1, None, None, None, None, "x", "y", 1),
        (2, "", "en", "s", 0, None, None, None),
        (3, "one two three four five six\nseven eight nine ten eleven twelve", "en", "s", 5, "x", "y", 1),
        (None, "a null id with some words of its own in one line", "en", "s", 5, "x", "y", 1),
    ]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns
        want = {1, 3, None} if name == "simhash_near_dedup" else {1, 2, 3, None}  # null and empty texts are copies
        assert {r["doc_id"] for r in out.collect()} == want, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() == 4
