"""Exact top-k by inner product with Fagin's threshold algorithm.

Vectors become integers, ``floor(scale * x)``. Candidates are dealt into blocks by a hash of
their id; a block keeps, for every dimension, its rows sorted by that dimension. A query walks
all lists of a block in parallel, from the top where its own component is positive and from the
bottom where it is negative, scores every row when it first meets it, and stops once no unseen
row can beat the k-th best: once the k-th score exceeds the inner product of the query with the
current list ends. (At equality an unseen row with a smaller id could still win.) The results of
the blocks are merged with one top-k per query.

Queries travel to blocks in packs, so a task holds one block and one pack at a time and no pair
of rows is ever a row of a table. Null vectors, vectors with null or non-finite components, and
rows with a null id take no part. A query is compared with the vectors of its own length, whatever
other lengths there are; empty vectors score 0. Equal rows with equal ids count once as a candidate and once as a
query. An empty table gives an empty result. Scores are exact integers; one that exceeds a long is an
error. Columns beside the two that are read are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_ROWS = 16_384
PACK_ROWS = 4_096


class Lists:
    """A block of integer vectors with its sorted lists."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")  # so that ties meet the smaller id first
        self.ids, self.whole = ids[order], rows[order]
        self.rows = self.whole.astype(np.float64)
        self.reach = max(abs(int(rows.max(initial=0))), abs(int(rows.min(initial=0))))
        self.lists = np.argsort(self.whole, axis=0, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(self.whole, self.lists, axis=0)

    def top(self, query: np.ndarray, own: int, k: int, depth: int = 64) -> list[tuple[int, int]]:
        """``(score, id)`` of the best ``k`` rows but ``own``, ties to the smaller id."""
        n, used = len(self.ids), np.flatnonzero(query)
        down = query[used] > 0
        # Doubles hold every sum where none can reach 2^53; beyond that Python's integers do.
        small = self.reach * sum(abs(w) for w in query.tolist()) < 1 << 53
        rows, weights = (self.rows, query.astype(np.float64)) if small else (self.whole, query.astype(object))
        seen = np.zeros(n, bool)
        seen[np.searchsorted(self.ids, own) : np.searchsorted(self.ids, own, "right")] = True
        best: list[tuple[int, int]] = []
        at = 0
        while at < n:
            stop = min(n, at + depth) if len(used) else n
            met = np.zeros(n, bool)
            if len(used):
                met[self.lists[n - stop : n - at, used[down]]] = True
                met[self.lists[at:stop, used[~down]]] = True
            else:
                met[:] = True
            new = np.flatnonzero(met & ~seen)
            seen[new] = True
            if len(new):
                scores = rows[new] @ weights if small else rows[new].astype(object) @ weights
                if small and len(new) > k:
                    edge = np.partition(scores, len(new) - k)[len(new) - k]
                    new, scores = new[scores >= edge], scores[scores >= edge]
                    first = np.lexsort((new, -scores))[:k]
                    new, scores = new[first], scores[first]
                best = sorted(best + [(-int(s), int(self.ids[i])) for s, i in zip(scores, new)])[:k]
            if stop < n and len(best) == k:
                ends = np.where(down, self.sorted[n - stop, used], self.sorted[stop - 1, used])
                if -best[-1][0] > int(ends.astype(weights.dtype) @ weights[used]):
                    break
            at, depth = stop, depth * 2
        return [(-s, i) for s, i in best]


def quantised(vector: Column, scale: int) -> Column:
    """The integer vector, or null if it is null or holds a null or non-finite component."""
    wide = vector.cast("array<double>")
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.when(~bad, F.transform(wide, lambda x: F.floor(x * F.lit(float(scale)))))


def exact_top_k(
    vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding",
    scale: int = 256, block_rows: int = BLOCK_ROWS, pack_rows: int = PACK_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for every row of ``queries`` among ``vectors``."""

    def ready(df: DataFrame) -> DataFrame:
        own = df.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("v"))
        return own.filter("id is not null and v is not null").dropDuplicates(["id", "v"])

    rows, asked = ready(vectors), ready(queries)
    blocks = max(1, -(-rows.count() // block_rows))
    packs = max(1, -(-asked.count() // pack_rows))
    rows, asked = (df.withColumn("dim", F.size("v")) for df in (rows, asked))

    def hashed(n: int) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(n))

    def upto(n: int) -> Column:
        return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))

    # Every block meets every pack: the stated queries against all rows, in blocks.
    pack = hashed(packs).alias("pack")
    dealt_rows = rows.withColumn("block", hashed(blocks)).select(
        "block", F.explode(upto(packs)).alias("pack"), "dim", "id", "v"
    )
    dealt_asked = asked.select(
        F.explode(upto(blocks)).alias("block"), pack, "dim", "id", "v"
    )

    def search(key: tuple, candidates: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int]] = []
        if len(candidates) and len(wanted):
            ids = candidates["id"].to_numpy(np.int64)
            lists = Lists(ids, np.array(candidates["v"].tolist(), np.int64).reshape(len(ids), int(key[2])))
            for own, vector in sorted(zip(wanted["id"].tolist(), wanted["v"].tolist()), key=lambda x: x[0]):
                out += [(own, i, s) for s, i in lists.top(np.asarray(vector, np.int64), own, k)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"], dtype=np.int64)

    schema = T.StructType().add("query_id", "long").add("vec_id", "long").add("score", "long")
    met = ("block", "pack", "dim")
    local = dealt_rows.groupBy(*met).cogroup(dealt_asked.groupBy(*met)).applyInPandas(search, schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return local.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
