"""Benchmark decontamination by greedy string tiling.

Texts are words: runs of letters and digits, in lower case. Seeds are runs of ``min_match``
words that a document shares with a benchmark item. For every pair with seeds, tiles are marked
greedily: Karp-Rabin hashes find the longest run of unmarked words that both sides share, it is
marked on both sides, and so on down to ``min_match`` words. Tiles never overlap and may come in
any order, so reordered passages count. The share of an item's words that lie in tiles is its
coverage. Items shorter than ``min_match`` use their own length, but have no run that tells a passage
from chance: they count only in a text of which they are the share ``min_coverage`` or more.

Null texts and texts without words are neither contaminated nor contaminate. Repeated rows get
the same result each. Null ids are kept, and ids may be of any type. Very long texts are read whole.
Empty tables give empty results. Other columns stay as they are in :func:`clean_documents`, whatever
their names.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from assayer.llm.subwords import live, pieces

WORDS = re.compile(r"[^\W_]+")
BREAKS = re.compile(r"[\W_]")
_BASE = np.uint64(0x9E37_79B9_7F4A_7C15)


@dataclass(frozen=True)
class TilingConfig:
    """``block_chars``: benchmark text that one pass over the documents holds in memory."""

    min_match: int = 5
    min_coverage: float = 0.5
    block_chars: int = 16_000_000


def run_hashes(ids: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hash of every run of ``length`` ids, rolled by one position at a time."""
    if len(ids) < length:
        return np.zeros(0, np.uint64)
    # prefix[i] * base^-i is not needed: differences of prefix sums scaled by a power roll the window.
    powers = np.full(len(ids) + 1, _BASE)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((ids + 1).astype(np.uint64) * powers[:-1], dtype=np.uint64)])
    # Scale every window to the same power, the highest one.
    return (sums[length:] - sums[:-length]) * powers[len(ids) - length :: -1][: len(ids) - length + 1]


def _common_runs(a: np.ndarray, b: np.ndarray, length: int, free_a: np.ndarray, free_b: np.ndarray) -> list[tuple[int, int]]:
    """Starts ``(i, j)`` of equal runs of ``length`` unmarked words, checked word by word."""

    def open_runs(free: np.ndarray, n: int) -> np.ndarray:
        marked = np.concatenate([[0], np.cumsum(~free)])
        return np.flatnonzero(marked[length:] == marked[:-length]) if n >= length else np.zeros(0, np.int64)

    at_a, at_b = open_runs(free_a, len(a)), open_runs(free_b, len(b))
    if not len(at_a) or not len(at_b):
        return []
    size = max(len(a), len(b))
    pad = lambda x: np.concatenate([x, np.full(size - len(x), -1, x.dtype)])  # noqa: E731  same powers on both sides
    hash_a, hash_b = run_hashes(pad(a), length)[at_a], run_hashes(pad(b), length)[at_b]
    order = np.argsort(hash_b, kind="stable")
    low, high = np.searchsorted(hash_b[order], hash_a, "left"), np.searchsorted(hash_b[order], hash_a, "right")
    out = []
    for k in np.flatnonzero(high > low):
        i = int(at_a[k])
        for j in at_b[order[low[k] : high[k]]].tolist():
            if np.array_equal(a[i : i + length], b[j : j + length]):
                out.append((i, j))
    return out


def tile(item: np.ndarray, doc: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Tiles ``(start in item, start in doc, words)``, the longest first, the leftmost among equals.

    The length of the longest run is found by bisection, since a run of some length holds runs
    of every smaller one; ids below 0 match nothing.
    """
    tiles: list[tuple[int, int, int]] = []
    free_item, free_doc = item >= 0, doc >= 0
    longest = min(len(item), len(doc))
    while longest >= min_match:
        low, high, best = min_match, longest, []
        while low <= high:
            length = (low + high) // 2
            if found := _common_runs(item, doc, length, free_item, free_doc):
                best, low = found, length + 1
            else:
                high = length - 1
        if not best:
            break
        longest = low - 1
        for i, j in best:
            if free_item[i : i + longest].all() and free_doc[j : j + longest].all():
                free_item[i : i + longest] = False
                free_doc[j : j + longest] = False
                tiles.append((i, j, longest))
    return tiles


class Benchmark:
    """A block of benchmark items, indexed by seed."""

    def __init__(self, items: Sequence[tuple[object, str | None]], config: TilingConfig):
        self.config = config
        self.words: dict[str, int] = {}
        self.items, self.seeds = [], {}
        for key, text in items:
            ids = [self.words.setdefault(w, len(self.words)) for w in WORDS.findall((text or "").lower())]
            if not ids:
                continue
            array = np.array(ids, np.int64)
            length = min(config.min_match, len(ids))
            for run in zip(*(ids[k:] for k in range(length))):
                owners = self.seeds.setdefault(length, {}).setdefault(run, [])
                if not owners or owners[-1] != len(self.items):
                    owners.append(len(self.items))
            self.items.append((key, array))
        # A seed is looked up by hash for all positions of a text at once, then exactly.
        self.tables = {
            length: np.unique(self._hash(np.array(list(runs), np.int64).reshape(-1, length)))
            for length, runs in self.seeds.items()
        }

    @staticmethod
    def _hash(runs: np.ndarray) -> np.ndarray:
        out = np.zeros(len(runs), np.uint64)
        for column in runs.T:
            out = (out + column.astype(np.uint64) + np.uint64(1)) * _BASE
            out ^= out >> np.uint64(31)
        return out

    def matches(self, text: str | None) -> list[tuple[object, float, int]]:
        """``(item, coverage, tiles)`` of the items that a text covers enough."""
        get = self.words.get
        ids = np.array(
            [get(w, -1) for part in pieces((text or "").lower(), BREAKS) for w in WORDS.findall(part)], np.int64
        )
        shared: dict[int, list[tuple[int, int]]] = {}  # item: (start, length) of its seeds in the text
        for length, table in self.tables.items():
            short = length < self.config.min_match and length < self.config.min_coverage * len(ids)
            if len(ids) < length or short:
                continue
            runs = np.lib.stride_tricks.sliding_window_view(ids, length)
            known = np.flatnonzero((runs >= 0).all(axis=1))
            hashes = self._hash(runs[known])
            hit = np.searchsorted(table, hashes)
            hit[hit == len(table)] = 0
            for at in known[table[hit] == hashes].tolist():
                for item in self.seeds[length].get(tuple(ids[at : at + length].tolist()), ()):
                    shared.setdefault(item, []).append((at, length))
        out = []
        for number, seeds in shared.items():
            key, item = self.items[number]
            # Words outside every seed can be in no tile; a gap keeps neighbours apart.
            inside = np.zeros(len(ids) + 1, bool)
            for at, length in seeds:
                inside[at : at + length] = True
            gap = inside[:-1] & ~inside[1:]
            keep = np.flatnonzero(inside[:-1])
            part = np.insert(ids[keep], np.flatnonzero(gap[keep]) + 1, -1)
            tiles = tile(item, part, min(self.config.min_match, len(item)))
            coverage = sum(n for _, _, n in tiles) / len(item)
            if coverage >= self.config.min_coverage:
                out.append((key, coverage, len(tiles)))
        return out


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, config: TilingConfig) -> Iterator[list[tuple]]:
    """Benchmark items in blocks of bounded size, read one partition at a time."""
    block, chars = [], 0
    for row in benchmark.select(id_col, text_col).toLocalIterator():
        size = len(row[1] or "") + 32
        if block and chars + size > config.block_chars:
            yield block
            block, chars = [], 0
        block.append((row[0], row[1]))
        chars += size
    if block:
        yield block


def matches_column(text: Column, items: list[tuple], id_type: T.DataType, config: TilingConfig, spark) -> Column:
    """``array<struct(item_id, coverage, tiles)>`` of a whole text against one block of items."""
    held, key = spark.sparkContext.broadcast(items), uuid.uuid4().hex
    kind = T.ArrayType(T.StructType().add("item_id", id_type).add("coverage", "double").add("tiles", "integer"))
    arrow = pa.list_(pa.struct([("item_id", to_arrow_type(id_type)), ("coverage", pa.float64()), ("tiles", pa.int32())]))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        block = live(key, lambda: Benchmark(held.value, config))
        for batch in batches:
            yield pa.array(
                [
                    [{"item_id": k, "coverage": c, "tiles": n} for k, c, n in block.matches(text)]
                    for text in batch.to_pylist()
                ],
                arrow,
            )

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, kind)(text)


def contaminations(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", config: TilingConfig = TilingConfig(),
) -> DataFrame:
    """``id, item_id, coverage, tiles`` of every document and item it covers enough.

    The benchmark is joined block by block: one block, of bounded size, is on every executor
    while the documents are scanned, so no document text is shuffled.
    """
    item_type = benchmark.schema[item_col].dataType
    schema = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, item_id {item_type.simpleString()}, coverage double, tiles int"
    out = None
    for block in _blocks(benchmark, item_col, item_text_col, config):
        found = docs.select(
            F.col(id_col).alias("_id"),
            F.explode(matches_column(F.col(text_col), block, item_type, config, docs.sparkSession)).alias("_m"),
        ).select(F.col("_id").alias(id_col), "_m.item_id", "_m.coverage", "_m.tiles")
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def clean_documents(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", config: TilingConfig = TilingConfig(),
) -> DataFrame:
    """The rows of ``docs``, all columns, whose text covers no benchmark item enough."""
    item_type = benchmark.schema[item_col].dataType
    for block in _blocks(benchmark, item_col, item_text_col, config):
        docs = docs.filter(F.size(matches_column(F.col(text_col), block, item_type, config, docs.sparkSession)) == 0)
    return docs
