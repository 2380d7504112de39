"""Model batches of like lengths, settings side by side, and mergeable length sketches."""

import numpy as np
import pandas as pd
import pytest

from assayer.operators import audit
from assayer.operators.model import ModelConfig, fit_classifier, fixed_validation_select, predict
from assayer.operators.scoring import batch_former, batched_scorer


def _frames(sizes, arrow):
    rows = pd.DataFrame({"id": range(len(sizes)), "text": ["x" * n if n >= 0 else None for n in sizes]})
    return (rows.iloc[i : i + arrow].reset_index(drop=True) for i in range(0, len(rows), arrow))


def _padding(batches):
    longest = [max(len(t or "") for t in b["text"]) for b in batches]
    return sum(n * len(b) for n, b in zip(longest, batches)) - sum(len(t or "") for b in batches for t in b["text"])


def test_batches_carry_over_and_pad_less():
    sizes = np.random.default_rng(2).integers(0, 3000, 1013).tolist() + [-1] * 6
    batches = list(batch_former("text", 32, None)(_frames(sizes, 100)))
    assert sorted(i for b in batches for i in b["id"]) == list(range(len(sizes)))
    assert len(batches) == -(-len(sizes) // 32) and all(len(b) == 32 for b in batches[:-1])  # none short but the last
    plain = [f.iloc[i : i + 32] for f in _frames(sizes, 100) for i in range(0, len(f), 32)]
    assert len(plain) > len(batches) and _padding(batches) < 0.4 * _padding(plain)


def test_batches_keep_to_the_budget():
    sizes = [5, 9000, 10, 10, 10, 400, 400, 400, 0, 1, 2, 3]
    batches = list(batch_former("text", 4, 1000)(_frames(sizes, 5)))
    assert sorted(i for b in batches for i in b["id"]) == list(range(len(sizes)))
    for b in batches:
        assert len(b) <= 4 and (len(b) == 1 or len(b) * max(len(t) for t in b["text"]) <= 1000)
    assert list(batch_former("text", 4, 10)(iter([]))) == []


def test_labels_do_not_depend_on_the_batches(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2] * (i % 97)) for i in range(3000)] + [(-1, None)], "id int, text string").repartition(3)

    def load():
        return lambda batch: np.array([[float(len(t or "")) % 5, float((t or "").count("a")), 2.0, 0, 0, 0] for t in batch])

    got = [
        {r["id"]: r["predicted_category"] for r in batched_scorer(df, "text", load, size, max_padded=budget).collect()}
        for size, budget in ((32, None), (7, 300), (1, None))
    ]
    assert got[0] == got[1] == got[2] and len(got[0]) == 3001


def test_settings_side_by_side_choose_as_one_by_one(spark):
    rows = [(i, f"{'get list' if i % 3 else 'set put'} thing{i % 11} part{i % 7}", "Read" if i % 3 else "Write") for i in range(150)]
    df = spark.createDataFrame(rows, "id int, text string, category string")
    train, held = df.filter("id % 5 <> 0"), df.filter("id % 5 = 0")
    grid = [ModelConfig(c=0.0001), ModelConfig(c=4.0), ModelConfig(c=4.0, min_df=1), ModelConfig(c=0.01)]
    tables, winners = zip(*[
        (sorted(map(tuple, t.collect())), w) for w, t in (fixed_validation_select(train, held, grid, side_by_side=n) for n in (1, 4))
    ])
    assert tables[0] == tables[1] and sum(row[-1] for row in tables[0]) == 1
    alone = fit_classifier(train, config=grid[next(row[0] for row in tables[0] if row[-1])])
    want = {r["id"]: r["predicted_category"] for r in predict(alone, held).collect()}
    assert {r["id"]: r["predicted_category"] for r in predict(winners[1], held).collect()} == want


def test_sketches_merge_within_the_stated_error(spark):
    rng = np.random.default_rng(8)
    parts = [rng.lognormal(5, 1, 30_000).astype(int), rng.integers(0, 50, 20_000), rng.lognormal(8, 0.5, 10_000).astype(int)]
    rows = pd.DataFrame({"day": np.repeat([1, 2, 3], [len(p) for p in parts]), "n": np.concatenate(parts)})
    states = [
        audit.length_sketches(spark.createDataFrame(rows[rows.day == d]).repartition(4), "n", 900).collect()[0] for d in (1, 2, 3)
    ]
    table = spark.createDataFrame(states)
    assert all(len(s["sketch"]) < 200_000 for s in states)
    got = audit.sketched_percentiles(table).collect()[0]
    every = np.sort(rows["n"].to_numpy())
    assert got["rows"] == len(every) and got["share_within"] == pytest.approx((every <= 900).mean())
    for name, q in (("p95", 0.95), ("p99", 0.99)):
        low, high = np.searchsorted(every, got[name], "left"), np.searchsorted(every, got[name], "right")
        assert low / len(every) <= q + audit.rank_error() and high / len(every) >= q - audit.rank_error()
    nothing = audit.length_sketches(spark.createDataFrame([(None,)], "n int"), "n", 9)
    assert tuple(audit.sketched_percentiles(nothing).select("rows", "p95", "p99").collect()[0]) == (1, None, None)
