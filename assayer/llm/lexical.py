"""Exact ranked lexical search: best-first search of sparse ball trees over blocks of documents.

A document is a sparse vector of integers, ``(10^9 tf) div (1000 tf + 8 m)`` per term, and a score is its
inner product with the integer weights of an item's terms. One pass over the texts counts the terms that
some item of the pack asks for and stores them; totals and document frequencies come from that table.
Its partitions are cut into blocks, and every block becomes a ball tree: a node is halved at the median of
the projection on two far documents, and holds the centroid and the radius of its documents. The centroid's
terms are all terms of the documents below, so an item's other terms add nothing there: with q as the rest,
no document below scores more than ``q . centroid + |q| * radius``. Subtrees are visited best first until
the bound falls below the k-th score; leaves are scored in 64-bit integers.

Rounding is safe: radii and bounds are doubles that are raised by more than their rounding errors, and
a node is dropped only if its bound is below the k-th score, not if it is equal, since ties go by id.

Items reach the workers in packs of at most ``pack_chars`` characters (one item at least), in the order
of a hash of the item: the stated query set against all rows, in blocks. Results of the blocks are merged
by one top-k per item.

Null texts and texts without a term have no score and count in no statistic. Every row is a document of
its own, also where ids or texts repeat; a null id comes after all others among equal scores. Items with
equal id and text count once; an id with several texts is ranked for the terms of all of them together.
Very long texts are counted whole. An empty table on either side gives an empty result, and other columns
are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.llm.linededup import stored

# The constants of the score.
SCALE, TF_SCALE, LENGTH_SCALE, LENGTH_BASE, LENGTH_SHARE = 1_000_000_000, 1000, 8, 10, 90


@dataclass(frozen=True)
class SearchConfig:
    block_rows: int = 8_192  # documents of one tree
    block_entries: int = 2_000_000  # counted terms of one tree, unless one document has more
    leaf_rows: int = 64
    pack_chars: int = 1_000_000


def _byte_table() -> bytes:
    """Lower case for A-Z, a blank for every other ASCII character but digits and a-z."""
    kept = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
    lower = {c: c + 32 for c in range(0x41, 0x5B)}
    return bytes(lower.get(c, c if c in kept else 0x20) for c in range(256))


BYTE_TABLE = _byte_table()


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters, ASCII digits and other characters, A-Z in lower case; bytes of UTF-8."""
    return text.translate(BYTE_TABLE).split()


class BallTree:
    """Sparse integer rows in a tree of balls; ``scanned`` counts the rows that were scored."""

    # The doubles' relative error of a sum of n products is below n * 2^-53, far less than this.
    SLACK = 1e-9

    def __init__(self, starts: np.ndarray, terms: np.ndarray, values: np.ndarray, width: int, leaf_rows: int):
        self.starts, self.terms, self.values, self.width = starts, terms, values, width
        self.norms = self._sums(values.astype(np.float64) ** 2, starts)
        self.nodes: list[tuple] = []
        self.scanned = 0
        rows = np.arange(len(starts) - 1)
        if len(rows):
            self._build(rows, leaf_rows)

    def _entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the entries of ``rows``, and where each row begins among them."""
        first, sizes = self.starts[rows], self.starts[rows + 1] - self.starts[rows]
        begins = np.concatenate([[0], np.cumsum(sizes)])
        return np.repeat(first - begins[:-1], sizes) + np.arange(begins[-1]), begins

    @staticmethod
    def _sums(entries: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Sums of the entries of every row; rows without one sum to 0."""
        out = np.zeros(len(begins) - 1, entries.dtype)
        full = np.flatnonzero(begins[1:] > begins[:-1])
        if len(full):
            out[full] = np.add.reduceat(entries, begins[:-1][full])
        return out

    def _build(self, rows: np.ndarray, leaf_rows: int) -> int:
        places, begins = self._entries(rows)
        terms, values = self.terms[places], self.values[places].astype(np.float64)
        centre = np.bincount(terms, values, self.width) / len(rows)
        norm = float(centre @ centre)
        apart = self.norms[rows] + norm - 2 * self._sums(values * centre[terms], begins)
        slack = self.SLACK * (self.norms[rows] + norm)
        radius = math.sqrt(max(0.0, float((apart + slack).max()))) * (1 + self.SLACK)
        used = np.flatnonzero(centre)
        at = len(self.nodes)
        self.nodes.append(())
        if len(rows) <= leaf_rows:
            self.nodes[at] = (used, centre[used], radius, None, (rows, terms, self.values[places], begins))
            return at
        pivot = self._dense(rows[int(apart.argmax())])
        far = self.norms[rows] - 2 * self._sums(values * pivot[terms], begins)
        axis = self._dense(rows[int(far.argmax())]) - pivot
        order = np.argsort(self._sums(values * axis[terms], begins), kind="stable")
        half = len(rows) // 2
        children = tuple(self._build(np.sort(rows[part]), leaf_rows) for part in (order[:half], order[half:]))
        self.nodes[at] = (used, centre[used], radius, children, None)
        return at

    def _dense(self, row: int) -> np.ndarray:
        out = np.zeros(self.width)
        span = slice(self.starts[row], self.starts[row + 1])
        out[self.terms[span]] = self.values[span]
        return out

    def _bound(self, node: int, query: np.ndarray) -> float:
        used, centre, radius, _, _ = self.nodes[node]
        own = query[used]
        return (float(own @ centre) + math.sqrt(float(own @ own)) * radius) * (1 + self.SLACK)

    def top(self, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """``(score, row)`` of the best ``k`` rows with a score above 0, ties to the smaller row."""
        if not self.nodes:
            return []
        wide = query.astype(np.float64)
        queue = [(-self._bound(0, wide), 0)]
        best: list[tuple[int, int]] = []
        while queue:
            bound, node = heapq.heappop(queue)
            if not bound or (len(best) == k and -bound < -best[-1][0]):
                break  # without a bound above 0 no document holds a term of the item
            _, _, _, children, leaf = self.nodes[node]
            if children:
                for child in children:
                    heapq.heappush(queue, (-self._bound(child, wide), child))
                continue
            rows, terms, values, begins = leaf
            self.scanned += len(rows)
            scores = self._sums(query[terms] * values, begins)
            hits = np.flatnonzero(scores > (0 if len(best) < k else max(0, -best[-1][0] - 1)))
            if len(hits):
                found = sorted((-s, r) for s, r in zip(scores[hits].tolist(), rows[hits].tolist()))[:k]
                best = sorted(best + found)[:k]
        return [(-s, r) for s, r in best]


def _packs(items: DataFrame, id_col: str, text_col: str, pack_chars: int) -> Iterator[list[tuple]]:
    """Items in packs of at most ``pack_chars`` characters, one item at least; the driver holds one pack."""
    rows = items.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).dropDuplicates()
    texts = rows.groupBy("id").agg(F.concat_ws("\n", F.sort_array(F.collect_list("text"))).alias("text"))
    pack, size = [], 0
    for row in texts.orderBy(F.xxhash64("id", "text"), "id").toLocalIterator():
        if pack and size + len(row["text"]) > pack_chars:
            yield pack
            pack, size = [], 0
        pack.append((row["id"], sorted(set(terms_of(row["text"].encode())))))
        size += len(row["text"])
    if pack:
        yield pack


def counted_terms(docs: DataFrame, id_col: str, text_col: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """``id, n, terms, counts`` of every document with a term: its length, and what it holds of ``vocabulary``; stored."""
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(vocabulary)
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    kind = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("id", kind), T.StructField("n", T.LongType()),
        T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.IntegerType())),
    ])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, width = known.value.get, len(known.value) + 1
        for batch in batches:
            lengths, places = [], []
            for text in batch.column("text").to_pylist():
                words = terms_of(text) if text is not None else []
                lengths.append(len(words))
                places.append(np.fromiter((get(w, -1) for w in words), np.int64, len(words)))
            flat = np.concatenate(places) if places else np.zeros(0, np.int64)
            rows = np.repeat(np.arange(len(lengths)), lengths)
            met = flat >= 0
            keys, counts = np.unique(rows[met] * width + flat[met], return_counts=True)
            ends = np.searchsorted(keys, np.arange(len(lengths) + 1) * width).astype(np.int32)
            out = pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array(lengths, pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array((keys % width).astype(np.int32))),
                pa.ListArray.from_arrays(ends, pa.array(counts.astype(np.int32))),
            ], names=["id", "n", "terms", "counts"])
            yield out.filter(pc.greater(out.column("n"), 0))

    return stored(source.mapInArrow(count, schema))


def _frequencies(counted: DataFrame, width: int) -> dict[int, int]:
    """Document frequency by term: at most ``width`` rows, summed within each task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=width)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["term", "df"])

    partial = counted.select("terms").mapInArrow(count, "term int, df bigint")
    return {r["term"]: r["df"] for r in partial.groupBy("term").agg(F.sum("df").alias("df")).collect()}


def term_weight(total: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1)))


def _search(
    counted: DataFrame, pack: list[tuple], vocabulary: dict[bytes, int], total: int, length: int, k: int,
    config: SearchConfig,
) -> DataFrame:
    """``item, id, score`` of the best rows of every block."""
    width = len(vocabulary)
    dfs = _frequencies(counted, width)
    weights = np.zeros(width, np.int64)
    for place, df in dfs.items():
        weights[place] = term_weight(total, df)
    asked = counted.sparkSession.sparkContext.broadcast(
        [(i, np.array([vocabulary[t] for t in terms], np.int64)) for i, (_, terms) in enumerate(pack)]
    )
    schema = T.StructType([
        T.StructField("item", T.IntegerType()), counted.schema["id"], T.StructField("score", T.LongType()),
    ])

    def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts)
        # Rows in the order of their ids, so that ties go to the smaller row.
        rows = rows.take(pc.sort_indices(rows, [("id", "ascending")], null_placement="at_end")).combine_chunks()
        lists = rows.column("terms").combine_chunks()
        starts = lists.offsets.to_numpy().astype(np.int64)
        terms = lists.values.to_numpy()[starts[0] : starts[-1]].astype(np.int64)
        counts = rows.column("counts").combine_chunks()
        ends = counts.offsets.to_numpy()
        tf = counts.values.to_numpy()[ends[0] : ends[-1]].astype(np.int64)
        starts = starts - starts[0]
        m = LENGTH_BASE + (LENGTH_SHARE * rows.column("n").to_numpy() * total) // length
        values = (SCALE * tf) // (TF_SCALE * tf + LENGTH_SCALE * np.repeat(m, np.diff(starts)))
        tree = BallTree(starts, terms, values, width, config.leaf_rows)
        items, places, scores = [], [], []
        query = np.zeros(width, np.int64)
        for item, wanted in asked.value:
            query[wanted] = weights[wanted]
            for score, row in tree.top(query, k):
                items.append(item)
                places.append(row)
                scores.append(score)
            query[wanted] = 0
        ids = pa.concat_arrays(rows.column("id").take(pa.array(places, pa.int64())).chunks)
        found = [pa.array(items, pa.int32()), ids, pa.array(scores, pa.int64())]
        return pa.RecordBatch.from_arrays(found, names=["item", "id", "score"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held, entries = [], 0, 0
        for batch in batches:
            at, sizes = 0, np.cumsum(pc.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False))
            while at < batch.num_rows:
                before = int(sizes[at - 1]) if at else 0
                fit = int(np.searchsorted(sizes - before, max(1, config.block_entries - entries), "right"))
                fit = min(fit, at + config.block_rows - held)
                if fit <= at and not held:
                    fit = at + 1
                if fit > at:
                    parts.append(batch.slice(at, fit - at))
                    held, entries = held + fit - at, entries + int(sizes[fit - 1]) - before
                    at = fit
                if at < batch.num_rows:
                    yield block(parts)
                    parts, held, entries = [], 0, 0
        if parts:
            yield block(parts)

    return counted.filter(F.size("terms") > 0).mapInArrow(search, schema)


def ranked_search(
    docs: DataFrame, items: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", config: SearchConfig = SearchConfig(),
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best rows of ``docs`` for every item, scores above 0 only."""
    spark = docs.sparkSession
    id_kind, item_kind = docs.schema[id_col].dataType, items.schema[item_id_col].dataType
    found: DataFrame | None = None
    for pack in _packs(items, item_id_col, item_text_col, config.pack_chars):
        vocabulary = {t: i for i, t in enumerate(sorted({t for _, terms in pack for t in terms}))}
        if not vocabulary:
            continue
        counted = counted_terms(docs, id_col, text_col, vocabulary)
        facts = counted.agg(F.count(F.lit(1)).alias("total"), F.sum("n").alias("length")).first()
        if not facts["total"]:
            continue
        hits = _search(counted, pack, vocabulary, facts["total"], facts["length"], k, config)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        ranked = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        named = spark.createDataFrame(
            [(i, item) for i, (item, _) in enumerate(pack)],
            T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", item_kind)]),
        )
        # One row per item of the pack.
        part = ranked.join(F.broadcast(named), "item").select("item_id", "rank", F.col("id").alias(id_col), "score")
        found = part if found is None else found.unionByName(part)
    if found is None:
        schema = T.StructType([
            T.StructField("item_id", item_kind), T.StructField("rank", T.IntegerType()),
            T.StructField(id_col, id_kind), T.StructField("score", T.LongType()),
        ])
        return spark.createDataFrame([], schema)
    return found
