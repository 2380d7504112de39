"""Top-k over vectors of several lengths."""

import math

from assayer.llm import topk


def test_vectors_meet_those_of_their_own_length(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, [1.0, 1.0, 1.0]), (5, [1.0, 1.0, 3.0]), (6, [9.0] * 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {tuple(r) for r in topk.exact_top_k(df, df.filter("vec_id in (1, 4, 6)"), 2, scale=1).collect()}
    assert got == {(1, 1, 2, 2), (1, 2, 3, 0), (4, 1, 5, 5)}


def test_scores_beyond_doubles_are_exact(spark):
    """Sums of integers above 2^53, which doubles cannot tell apart."""
    rows = [(1, [2.0**20, 0.0]), (2, [2.0**20, 1.0 / 256]), (3, [2.0**20, 3.0 / 256]), (50, [2.0**20, 1.0 / 256]), (51, [-(2.0**20), 5.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id bigint, embedding array<double>, id string, rank int")
    got = topk.exact_top_k(df, df.filter("vec_id = 50"), k=4).collect()
    ints = {i: [math.floor(256 * x) for x in v] for i, v in rows}
    want = sorted((-sum(a * b for a, b in zip(ints[50], v)), i) for i, v in ints.items() if i != 50)
    assert [(r["score"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"])] == [(-s, i) for s, i in want]
