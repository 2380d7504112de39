import csv
import json
import os

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from assayer.labels import LABELS
from assayer.operators import audit, errors, membership, overlap, splitting, tfidf
from assayer.operators import records as R
from assayer.operators.model import (
    MacroF1Evaluator,
    ModelConfig,
    cut_terms,
    fit_classifier,
    fit_features,
    fixed_validation_select,
    predict,
)
from assayer.operators.scoring import batched_scorer
from assayer.operators.skew import hot_keys, salted_join
from assayer.plans import jobs
from assayer.session import materialize
from assayer.sinks import files
from assayer.sources import records as S

WORDS = {"Read": "list get show", "Write": "create update set", "Execute": "run launch start"}


def parts(path, ending):
    names = sorted(n for n in os.listdir(path) if n.startswith("part-") and n.endswith(ending))
    return [os.path.join(path, n) for n in names]


def json_rows(path):
    return [json.loads(line) for p in parts(path, ".json") for line in open(p, encoding="utf-8")]


def write_lines(path, lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


@pytest.fixture(scope="module")
def records(spark):
    rows = []
    for i in range(180):
        label = list(WORDS)[i % 3]
        split = ("train", "validation", "test")[0 if i % 10 < 6 else 1 if i % 10 < 8 else 2]
        rows.append(
            (i, f"r{i}", f"g{i % 10}", split, f"tool {i % 7}", f"{WORDS[label]} item {i % 5}",
             '{"properties":{"id":{"type":"string"}}}', None if split == "test" else label)
        )
    return spark.createDataFrame(
        rows, "ordinal bigint, record_id string, server_slug string, split string, name string,"
        " description string, input_schema string, category string",
    )


@pytest.fixture(scope="module")
def texts(records):
    return R.with_input_text(records).withColumnRenamed("input_text", "text")


@pytest.fixture(scope="module")
def model(texts):
    return fit_classifier(texts.filter("split = 'train'"))


def test_jsonl_scan(spark, tmp_path):
    good = write_lines(tmp_path / "a.jsonl", [
        '{"record_id":"1","server_slug":"s","name":null,"input_schema":"{}"}', "", "   ",
        '{"record_id":"2","server_slug":"s","description":"d","category":"Read"}',
    ])
    got = S.load_records(spark, good).orderBy("ordinal").drop("ordinal").collect()
    assert [tuple(r) for r in got] == [("1", "s", "", "", "{}", None), ("2", "s", "", "d", "", "Read")]
    bad = write_lines(tmp_path / "b.jsonl", ['{"record_id":"1","server_slug":"s"}', "{oops"])
    with pytest.raises(Exception, match="(?i)malformed"):
        S.load_records(spark, bad).collect()
    rejects = S.read_jsonl_rejects(spark, bad, S.RECORD_SCHEMA).collect()
    assert [(r.line_no, r.line) for r in rejects] == [(2, "{oops")]
    assert rejects[0].file_path.endswith("b.jsonl")
    no_id = write_lines(tmp_path / "c.jsonl", ['{"server_slug":"s"}'])
    with pytest.raises(Exception, match="record_id is missing"):
        S.load_records(spark, no_id).collect()


def test_file_order_survives_many_splits(spark, tmp_path):
    path = write_lines(tmp_path / "o.jsonl", [
        json.dumps({"record_id": str(i), "server_slug": "s", "description": "x" * 50}) for i in range(3000)
    ])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = S.load_records(spark, path)
        assert df.rdd.getNumPartitions() > 4
        assert [int(r.record_id) for r in df.orderBy("ordinal").collect()] == list(range(3000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_reject_line_numbers_over_many_splits(spark, tmp_path):
    (tmp_path / "many").mkdir()
    want = set()
    for name, step in (("x", 700), ("y", 450)):
        lines = [json.dumps({"record_id": str(i), "server_slug": "s" * 40}) for i in range(2000)]
        for i in range(5, 2000, step):
            lines[i] = "{bad" if i % 2 else "[1"
            lines[i - 1] = ""
            want.add((f"{name}.jsonl", i + 1, lines[i]))
        write_lines(tmp_path / "many" / f"{name}.jsonl", lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = S.read_jsonl_rejects(spark, str(tmp_path / "many"), S.RECORD_SCHEMA).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {(os.path.basename(r.file_path), r.line_no, r.line) for r in rows} == want


def test_servers_and_scored_files(spark, tmp_path, records):
    path = write_lines(tmp_path / "s.jsonl", ['{"slug":"x","name":"Read files"}', '{"slug":"y","description":"z"}'])
    servers = S.read_servers(spark, path)
    scan = audit.label_word_scan(servers).first()
    assert (scan.rows_scanned, scan.rows_with_label_word) == (2, 1)
    assert [(r.slug, r.matched) for r in audit.first_hits(servers).collect()] == [("x", ["read"])]
    scored = jobs.scored_records(R.labelled(records).withColumn("predicted_category", F.lit("Read")))
    files.write_scored_jsonl(scored, str(tmp_path / "scored"))
    back = S.read_scored(spark, str(tmp_path / "scored"))
    assert back.count() == scored.count()
    assert back.drop("ordinal").exceptAll(scored.drop("ordinal")).isEmpty()


def test_csv_quotes_and_line_ends(spark, tmp_path):
    ids = ["plain", "a,b", 'say "x"', "two\nlines", "cr\r", " padded "]
    df = spark.createDataFrame([(i, v, "Read") for i, v in enumerate(ids)], "ordinal int, record_id string, category string")
    files.write_predictions_csv(df.coalesce(1), str(tmp_path / "p"), "ordinal")
    rows, raw = [], b""
    for p in parts(str(tmp_path / "p"), ".txt"):
        raw += open(p, "rb").read()
        rows += list(csv.DictReader(open(p, newline="", encoding="utf-8")))
    assert [r["record_id"] for r in rows] == ids
    assert b'"say ""x"""' in raw and raw.startswith(b"record_id,category\r\n")


def test_audit_document(spark, tmp_path, records):
    servers = records.select("ordinal", F.col("server_slug").alias("slug"), "name", "description")
    files.write_report_json(jobs.audit_document(records, servers), str(tmp_path / "audit"))
    (doc,) = json_rows(str(tmp_path / "audit"))
    train = doc["splits"]["train"]
    assert train["rows"] == 108 and train["servers"] == 6 and train["duplicate_record_ids"] == 0
    assert sum(train["label_counts"].values()) == 108
    assert doc["cross_split_leakage"]["server_slug_overlap"] == {
        "train_vs_validation": 0, "train_vs_test": 0, "validation_vs_test": 0}
    assert doc["server_label_word_scan"]["rows_scanned"] == 180


def test_empty_split_statistics(spark, records):
    none = records.filter("split = 'nowhere'")
    zeros = audit.audit_splits(none).collect()
    assert sorted(r["split"] for r in zeros) == ["test", "train", "validation"]
    assert all(not any(v for k, v in r.asDict().items() if k != "split") for r in zeros)
    only_train = audit.audit_splits(records.filter("split = 'train'")).collect()
    assert {r["split"]: r["rows"] for r in only_train} == {"train": 108, "validation": 0, "test": 0}
    assert {r.overlap for r in overlap.overlap_counts(none, "server_slug").collect()} == {0}


def test_train_save_load_predict(spark, tmp_path, records, texts, model):
    path = str(tmp_path / "model")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    held_out = texts.filter("split = 'validation'")
    first = predict(model, held_out).select("record_id", "predicted_category")
    second = predict(loaded, held_out).select("record_id", "predicted_category")
    assert first.exceptAll(second).isEmpty()
    assert MacroF1Evaluator().evaluate(predict(model, held_out)) == 0.5  # three of six labels occur
    assert files.artifact_size_mb(spark, path).first().size_mb > 0
    again = fit_classifier(texts.filter("split = 'train'"))
    assert first.exceptAll(predict(again, held_out).select("record_id", "predicted_category")).isEmpty()


def test_features_match_definition(spark, texts, model):
    docs = texts.filter("split = 'train'")
    long = tfidf.tfidf(docs, "record_id", "text").filter("record_id = 'r0'").collect()
    vector = PipelineModel(model.stages[:5]).transform(docs.filter("record_id = 'r0'")).first().features
    assert np.allclose(sorted(r.tfidf for r in long), sorted(vector.values))
    assert abs(sum(r.tfidf ** 2 for r in long) - 1) < 1e-9


def test_tfidf_by_shuffle_equals_broadcast(spark, texts):
    small = tfidf.tfidf(texts, "record_id", "text")
    large = tfidf.tfidf(texts, "record_id", "text", broadcast_bytes=0)
    as_set = lambda df: {(r.record_id, r.term, r.n, r.df, round(r.tfidf, 9)) for r in df.collect()}
    assert as_set(small) == as_set(large)


def test_terms_are_sorted_whatever_the_partitioning(texts):
    docs = texts.filter("split = 'train'")
    lists = [fit_features(cut_terms(docs.repartition(n), "text"), "text", ModelConfig())[1].vocabulary for n in (1, 5)]
    assert lists[0] == lists[1] == sorted(lists[0])


def test_group_columns_are_refused(records):
    with pytest.raises(ValueError, match="server_slug"):
        R.refuse_group_columns(records)


def test_select_on_the_given_validation_split(texts):
    _, table = fixed_validation_select(
        texts.filter("split = 'train'"), texts.filter("split = 'validation'"),
        [ModelConfig(c=0.001), ModelConfig(c=4.0)],
    )
    rows = table.orderBy("setting").collect()
    assert sum(r.chosen for r in rows) == 1
    best = max(rows, key=lambda r: (r.macro_f1, -r.setting))
    assert best.chosen


def test_predict_to_csv(spark, tmp_path, records, model):
    summary = jobs.predict_to_csv(records, lambda t: predict(model, t), str(tmp_path / "out"))
    assert summary["rows"] == 180 and summary["rows_per_second"] > 0
    rows = [r for p in parts(str(tmp_path / "out"), ".txt") for r in csv.DictReader(open(p, newline=""))]
    assert [r["record_id"] for r in rows] == [f"r{i}" for i in range(180)]
    assert {r["category"] for r in rows} <= set(LABELS)
    one = tmp_path / "one"
    jobs.predict_to_csv(records, lambda t: predict(model, t), str(one), single_file=True)
    (only,) = parts(str(one), ".txt")
    assert [r["record_id"] for r in csv.DictReader(open(only, newline=""))] == [f"r{i}" for i in range(180)]
    with pytest.raises(ValueError, match="no records"):
        jobs.predict_records(records.limit(0), lambda t: predict(model, t))


def test_invalid_prediction_commits_nothing(tmp_path, records):
    bad = lambda t: t.withColumn("predicted_category", F.lit("Maybe"))
    out = tmp_path / "bad"
    with pytest.raises(ValueError, match=r"180 predictions outside the label set, first: \[\('r0', 'Maybe'\), .*'r4'") as error:
        jobs.predict_to_csv(records, bad, str(out))
    assert str(error.value).count("Maybe") == 5 and not (out / "_SUCCESS").exists()
    with pytest.raises(Exception, match="outside the label set: Maybe"):
        jobs.predict_records(records, bad).collect()


def test_missing_predictions_are_errors(spark):
    rows = [(1, "Read", "Read"), (2, "Read", "Write"), (3, "Read", None), (4, "Write", None), (5, None, "Read")]
    scored = R.with_correct(spark.createDataFrame(rows, "ordinal long, category string, p string"), "category", "p")
    assert [r.correct for r in scored.orderBy("ordinal").collect()] == [True, False, False, False, None]
    known = scored.filter("category is not null")
    assert tuple(errors.error_rate(known).first()) == (4, 3, 75.0)
    named = known.withColumnsRenamed({"category": "true_category", "p": "predicted_category"})
    pairs = {r.pair: r.n for r in errors.top_pairs(named).collect()}
    assert pairs == {"Read_to_Write": 1, "Read_to_None": 1, "Write_to_None": 1}


def test_attach_predictions_checks_its_contract(spark):
    a = spark.createDataFrame([("1", "x"), ("2", "y")], "record_id string, name string")
    good = spark.createDataFrame([("2", "Read"), ("1", "Write")], "record_id string, p string")
    assert {tuple(r) for r in R.attach_predictions(a, good).collect()} == {("1", "x", "Write"), ("2", "y", "Read")}
    for rows, message in (
        ([("1", "Read"), ("1", "Read"), ("2", "Read")], "repeated record_id: 1"),
        ([("1", "Read")], "record without a prediction: 2"),
        ([("1", "Read"), ("2", "Read"), ("4", "Read")], "prediction without a record: 4"),
    ):
        bad = spark.createDataFrame(rows, "record_id string, p string")
        with pytest.raises(Exception, match=message):
            R.attach_predictions(a, bad).count()


def test_train_and_evaluate(tmp_path, records):
    _, scored = jobs.train_and_evaluate(
        records, str(tmp_path / "m"), str(tmp_path / "r"), scored_path=str(tmp_path / "s")
    )
    (doc,) = json_rows(str(tmp_path / "r"))
    assert doc["n_samples"] == scored.count() == 36
    assert list(doc["per_class"]) == list(LABELS)
    assert doc["confusion_matrix"]["labels"] == list(LABELS)
    assert sum(map(sum, doc["confusion_matrix"]["matrix"])) == 36
    assert doc["model"]["vocabulary_size"] > 0 and doc["model"]["size_mb"] > 0 and doc["model"]["train_seconds"] > 0
    rows = json_rows(str(tmp_path / "s"))
    assert len(rows) == 36 and sum(r["correct"] for r in rows) / 36 == pytest.approx(doc["accuracy"])


def test_error_analysis_file(spark, tmp_path, records):
    scored = jobs.scored_records(R.labelled(records).withColumn("predicted_category", F.lit("Read")))
    top = jobs.error_analysis(scored, str(tmp_path / "e"), top_pairs=1, examples_per_pair=2)
    (doc,) = json_rows(str(tmp_path / "e"))
    (pair,) = [r.pair for r in top.collect()]
    assert list(doc["examples"]) == [pair] and len(doc["examples"][pair]) == 2


def test_batched_scorer(spark):
    sizes = []

    def load():
        def score(batch):
            sizes.append(len(batch))
            assert len(batch) <= 4
            return np.array([[0, 1, 1, 0, 0, 0] if "x" in t else [0, 0, 0, 0, 0, 9] for t in batch])
        return score

    df = spark.createDataFrame([(i, "x" if i % 2 else "y") for i in range(30)], "id int, text string")
    got = {r.id: r.predicted_category for r in batched_scorer(df, "text", load, batch_size=4).collect()}
    assert got == {i: "Write" if i % 2 else "Other" for i in range(30)}


def test_argmax_ties(spark):
    df = spark.createDataFrame([([0.1, 0.5, 0.5],), ([2.0, 2.0, 2.0],), ([0.0, 0.0, 1.0],)], "s array<double>")
    assert [r[0] for r in df.select(R.argmax_id(F.col("s"))).collect()] == [1, 0, 2]


def test_alignment(spark):
    a = spark.createDataFrame([("1",), ("2",), ("2",), ("3",)], "record_id string")
    b = spark.createDataFrame([("1",), ("2",), ("4",)], "record_id string")
    row = R.alignment(a, b).first()
    assert (row.records, row.predictions, row.repeated, row.unmatched) == (4, 3, 1, 2)


def test_group_split(spark):
    rows = [(f"r{g}_{i}", f"g{g}", LABELS[g % 3]) for g in range(600) for i in range(1 + g % 7)]
    df = spark.createDataFrame(rows, "record_id string, server_slug string, category string")
    shares = [("train", 0.7), ("validation", 0.15), ("test", 0.15)]
    groups = splitting.group_stratified_split(df, shares, seed=1)
    out = splitting.assign_splits(df, groups)
    assert out.count() == len(rows)
    assert out.groupBy("server_slug").agg(F.count_distinct("split").alias("k")).filter("k > 1").isEmpty()
    total = len(rows)
    got = {r["split"]: r["n"] / total for r in out.groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert all(abs(got[name] - share) < 0.03 for name, share in shares)
    for label in LABELS[:3]:
        one = out.filter(F.col("category") == label)
        n = one.count()
        part = {r["split"]: r["n"] / n for r in one.groupBy("split").agg(F.count("*").alias("n")).collect()}
        assert all(abs(part[name] - share) < 0.05 for name, share in shares)
    same = splitting.group_stratified_split(df, shares, seed=1)
    other = splitting.group_stratified_split(df, shares, seed=2)
    assert same.exceptAll(groups).isEmpty() and not other.exceptAll(groups).isEmpty()


def test_salts_follow_the_share_of_a_key(spark):
    counts = spark.createDataFrame([("a", 40_000), ("b", 130), ("c", 5)] + [(f"k{i}", 10) for i in range(8000)], "key string, n long")
    hot = {r.key: r.salts for r in hot_keys(counts, "key", "n").collect()}
    assert hot == {"a": 333, "b": 2}
    fact = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"))
    sizes = fact.groupBy("key").agg(F.count("*").alias("n"))
    dim = spark.createDataFrame([("hot", 1)], "key string, v int")
    flagged = hot_keys(sizes, "key", "n")
    joined = salted_join(fact, dim, "key", flagged, "id")
    assert joined.count() == 10_000
    # No salt of the hot key holds much more than the share that makes a key hot.
    salts = flagged.first().salts
    per_salt = fact.filter("key = 'hot'").groupBy(F.pmod(F.xxhash64("id"), F.lit(salts))).count()
    assert per_salt.agg(F.max("count")).first()[0] <= 3 * 30_000 / 1000


@pytest.mark.parametrize("how", ["inner", "left_semi", "left_anti"])
def test_salted_join_with_a_hot_key(spark, how):
    fact = spark.range(5000).select(
        "id", F.when(F.col("id") % 3 != 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key")
    )
    dim = spark.createDataFrame([("hot", 1)] + [(f"k{i}", 2) for i in range(0, 50, 2)], "key string, v int")
    hot = hot_keys(fact.groupBy("key").agg(F.count("*").alias("n")), "key", "n", max_keys=10)
    assert [r.key for r in hot.collect()] == ["hot"]
    got = salted_join(fact, dim, "key", hot, "id", how)
    want = fact.join(dim, "key", how).select(*got.columns)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_lookalikes_partition_the_held_out_rows(spark, records):
    hashed = R.with_content_hash(records)
    like = overlap.lookalikes(hashed, "content_hash")
    clean = overlap.lookalikes(hashed, "content_hash", keep=False)
    assert like.count() + clean.count() == records.filter("split <> 'train'").count()
    trained = {r.content_hash for r in hashed.filter("split = 'train'").collect()}
    assert all(r.content_hash in trained for r in like.collect())
    marked = overlap.mark_lookalikes(hashed, "content_hash")
    assert marked.filter("lookalike").select("record_id").exceptAll(like.select("record_id")).isEmpty()
    assert marked.filter("not lookalike").select("record_id").exceptAll(clean.select("record_id")).isEmpty()


def test_membership_loses_no_key_and_lets_few_others_pass(spark):
    keys = spark.range(0, 20_000, 2).select(F.col("id").cast("string").alias("k"))
    rows = spark.range(40_000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("_row_"))
    got = membership.may_hold(rows, keys, "k")
    assert got.count() == 40_000
    assert got.filter("cast(k as int) < 20000 and cast(k as int) % 2 = 0 and not may_hold").isEmpty()
    assert got.filter("may_hold").count() < 10_000 + 30_000 / 8
    assert membership.may_hold(rows, keys.limit(0), "k").filter("may_hold").isEmpty()
    assert membership.bits_for(0) == membership.ROW_BITS and membership.bits_for(1 << 40) == membership.MAX_BITS


def test_lookalikes_with_null_repeated_and_hot_keys(spark):
    rows = [(i, "train", f"t{i}") for i in range(200)] + [(i, "test", "t7") for i in range(200, 500)]
    rows += [(500, "test", None), (501, "train", None), (502, "validation", "only"), (503, "validation", "t9"), (503, "validation", "t9")]
    table = spark.createDataFrame(rows, "ordinal bigint, split string, h string")
    got = [(r.ordinal, r.lookalike) for r in overlap.mark_lookalikes(table, "h").collect()]
    assert sorted(got) == sorted((i, h in ("t7", "t9")) for i, s, h in rows if s != "train")
    assert overlap.mark_lookalikes(table.limit(0), "h").isEmpty()
    assert overlap.held_out_keys(table, "h").count() == 4


def test_tfidf_stores_the_vocabulary_only_and_places_rows_once(spark, texts, monkeypatch):
    stored = []
    monkeypatch.setattr(tfidf, "materialize", lambda df: stored.append(df.columns) or materialize(df))
    weights = tfidf.tfidf(texts.unionByName(texts.limit(9)), "record_id", "text")
    assert stored == [["term", "df", "idf"]]
    plan = weights._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(record_id") == 1 and "hashpartitioning(term" not in plan
    assert max(r.df for r in weights.collect()) <= texts.select("record_id").distinct().count()


def test_terms_are_counted_within_the_row_where_ids_differ(spark):
    rows = [(1, "red red blue red blue sky"), (2, ""), (3, None), (4, "a b"), (None, "sky sky")]
    docs = spark.createDataFrame(rows, "id int, text string")
    plan = tfidf.term_counts(docs, "id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan
    both = [sorted(map(str, tfidf.term_counts(docs, "id", "text", repeat).collect())) for repeat in (None, False, True)]
    assert both[0] == both[1] == both[2] and "Row(id=1, term='red', n=3)" in both[0] and len(both[0]) == 9
    assert not tfidf.ids_repeat(docs, "id") and tfidf.ids_repeat(docs.union(docs.limit(1)), "id")
