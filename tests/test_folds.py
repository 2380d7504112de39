"""Folds that share out every label, with groups of mixed labels."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayer.labels import LABELS
from assayer.operators import splitting


@pytest.fixture(scope="module")
def rows():
    """Groups of all sizes whose labels mix; one group is large, two labels are rare."""
    rng = np.random.default_rng(4)
    out = []
    for group in range(900):
        size = 700 if group == 0 else int(rng.integers(1, 40))
        odds = rng.dirichlet([3, 2, 1, 1, 0.06, 0.04])
        out += [(None if group == 5 else f"g{group}", LABELS[i]) for i in rng.choice(6, size, p=odds)]
    return out + [("g7", None)] * 30


@pytest.fixture(scope="module")
def records(spark, rows):
    return spark.createDataFrame(rows, "server_slug string, category string").repartition(4)


def _shares(rows, where):
    by_label = collections.defaultdict(collections.Counter)
    for group, label in rows:
        by_label[label][where[group]] += 1
        by_label["rows"][where[group]] += 1
    return {label: {k: n / sum(c.values()) for k, n in c.items()} for label, c in by_label.items() if label}


@pytest.mark.parametrize("shares", [[1.0] * 5, [7.0, 1.5, 1.5]])
def test_every_label_has_its_share_in_every_fold(records, rows, shares):
    out = splitting.stratified_group_folds(records, shares, seed=3).collect()
    where = {r["server_slug"]: r["fold"] for r in out}
    assert len(out) == len(where) == len({g for g, _ in rows}) and sum(r["rows"] for r in out) == len(rows)
    for label, got in _shares(rows, where).items():
        n = sum(1 for _, x in rows if x == label) or len(rows)
        for fold, share in enumerate(shares):
            assert abs(got.get(fold, 0) - share / sum(shares)) < max(0.01, 12 / n), (label, fold, got)


def test_folds_follow_the_seed_and_nothing_else(records):
    a = splitting.stratified_group_folds(records, [1.0] * 4, seed=1)
    b = splitting.stratified_group_folds(records.repartition(9), [1.0] * 4, seed=1)
    c = splitting.stratified_group_folds(records, [1.0] * 4, seed=2)
    assert a.exceptAll(b).isEmpty() and not a.exceptAll(c).isEmpty()
    assert splitting.stratified_group_folds(records.limit(0), [1.0] * 4, seed=1).collect() == []


def test_holdout_in_two_steps(records, rows):
    out = splitting.holdout_split(records).collect()
    where = {r["server_slug"]: r["split"] for r in out}
    assert len(out) == len(where) == len({g for g, _ in rows})
    for label, got in _shares(rows, where).items():
        n = sum(1 for _, x in rows if x == label) or len(rows)
        for split, share in (("test", 1 / 7), ("validation", 1 / 7), ("train", 5 / 7)):
            assert abs(got.get(split, 0) - share) < max(0.015, 15 / n), (label, got)


def test_splits_reach_the_records(records, rows):
    groups = splitting.holdout_split(records.filter("server_slug is not null"))
    named = records.filter("server_slug is not null").withColumn("record_id", F.monotonically_increasing_id())
    assert splitting.assign_splits(named, groups).count() == sum(1 for g, _ in rows if g)
