"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint has 64 bits; a bit is 1 if it is set in over half of the hashes of the word
shingles. Two fingerprints at most ``2 r + 1`` bits apart are found like this: each emits all
variants within half that distance, rows meet by variant, and every meeting is verified.

For an odd distance of 3, half the distance is 1 for one fingerprint and 2 for the other. Their
numbers of set bits then differ in parity, so those of even parity emit the wider ball. Of three
differing bits two lie in the same half of the word, so pairs of flipped bits need not cross the
halves: 1057 variants for an even and 65 for an odd fingerprint, whatever the size of the input.

All fingerprints that reach a variant within one flip are within two bits of each other, and the
wider ones within three bits of those. So each is linked to the least of the former: one link per
row, never all pairs of a group. Equal fingerprints are merged before anything is emitted.

Null and empty texts have fingerprint zero and are linked like any other. Repeated rows share a
component. A null id is never a component id unless all ids of the component are null. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.llm.components import connected_components
from assayer.operators.skew import hot_keys, salted_join
from assayer.session import materialize

SEED = 42


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned fingerprint of a whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    span = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    total = len(words) - span + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, total, 8192):
        stop = min(total, at + 8192)
        hashes = np.array(
            [
                digest(joined[a:b], SEED)
                for a, b in zip(starts[at:stop].tolist(), ends[at + span - 1 : stop + span - 1].tolist())
            ],
            np.uint64,
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(ones * 2 > total, bitorder="little")
    return int(packed.view(np.uint64)[0])


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint_column(text: Column, shingle: int = 3) -> Column:
    """The fingerprint as a signed long with the same bits."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            prints = np.array([fingerprint(t, shingle) for t in batch.tolist()], np.uint64)
            yield pd.Series(prints.view(np.int64))

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, T.LongType())(text)


def _flips(distance: int) -> tuple[list[list[int]], list[list[int]]]:
    """Masks by number of flipped bits: for the narrow and for the wide side."""
    narrow = distance // 2
    wide = distance - narrow

    def masks(k: int, halves: bool) -> list[int]:
        groups = [range(32), range(32, 64)] if halves else [range(64)]
        return [sum(1 << b for b in bits) for g in groups for bits in combinations(g, k)]

    inner = [masks(k, False) for k in range(narrow + 1)]
    # With an odd distance of 3, two of the three flips may be taken from one half.
    return inner, inner + [masks(wide, distance == 3)] * (wide > narrow)


def ball_links(prints: DataFrame, col: str, distance: int = 3) -> DataFrame:
    """Links ``a, b`` that connect all distinct fingerprints at most ``distance`` bits apart."""
    if not 1 <= distance <= 3:
        raise ValueError("balls are emitted for distances of 1 to 3 bits")
    narrow, wide = _flips(distance)
    reach = len(narrow) - 1

    def table(levels: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        flat = np.array([m for level in levels for m in level], np.uint64).view(np.int64)
        return flat, np.repeat(np.arange(len(levels)), [len(level) for level in levels]).astype(np.int8)

    narrow_table, wide_table = table(narrow), table(wide)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy()
            odd = np.bitwise_count(values.view(np.uint64)) % 2 == 1
            for some, (masks, flips) in ((values[odd], narrow_table), (values[~odd], wide_table)):
                step = max(1, 200_000 // len(masks))
                for at in range(0, len(some), step):
                    own = some[at : at + step]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array((own[:, None] ^ masks).ravel()),
                            pa.array(np.repeat(own, len(masks))),
                        ],
                        names=["variant", "own"],
                    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by variant; a group is carried over from batch to batch."""
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64))

        def links(variant: np.ndarray, own: np.ndarray) -> pa.RecordBatch:
            same = np.concatenate([variant[1:] == variant[:-1], [False]])
            shared = same | np.concatenate([[False], same[:-1]])
            variant, own = variant[shared], own[shared]
            near = np.bitwise_count((variant ^ own).view(np.uint64)) <= reach
            starts = np.flatnonzero(np.concatenate([[True], variant[1:] != variant[:-1]])) if len(variant) else np.zeros(0, int)
            if len(starts):
                sizes = np.diff(np.concatenate([starts, [len(variant)]]))
                most = np.iinfo(np.int64).max
                has = np.repeat(np.logical_or.reduceat(near, starts), sizes)
                hub = np.repeat(np.minimum.reduceat(np.where(near, own, most), starts), sizes)
                close = np.bitwise_count((hub ^ own).view(np.uint64)) <= distance
                keep = has & close & (hub != own)
                a, b = hub[keep], own[keep]
            else:
                a = b = np.zeros(0, np.int64)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            variant = np.concatenate([held[0], batch.column(0).to_numpy()])
            own = np.concatenate([held[1], batch.column(1).to_numpy()])
            if not len(variant):
                continue
            last = np.searchsorted(variant, variant[-1])
            held = (variant[last:], own[last:])
            yield links(variant[:last], own[:last])
        yield links(*held)

    # A fingerprint becomes up to 1057 rows, so these few bytes are spread over all tasks first.
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    emitted = prints.select(col).repartition(tasks, col).mapInArrow(emit, "variant long, own long")
    met = emitted.repartition("variant").sortWithinPartitions("variant").mapInArrow(meet, "a long, b long")
    return met.distinct()


def rooted(nodes: DataFrame, distance: int) -> DataFrame:
    """``nodes``, one row per ``_print``, with ``_root``: the least fingerprint of the component."""
    found = connected_components(ball_links(nodes, "_print", distance), "a", "b")
    return nodes.join(found, F.col("_print") == F.col("node"), "left").select(
        *nodes.columns, F.coalesce("root", "_print").alias("_root")
    )


def component_heads(docs: DataFrame, key: str, text_col: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """``key, n``: the least ``key`` of every component and how many rows have it."""
    prints = materialize(docs.select(key, fingerprint_column(F.col(text_col), shingle).alias("_print")))
    nodes = materialize(prints.groupBy("_print").agg(F.min(key).alias("_least")))
    heads = rooted(nodes, distance).groupBy("_root").agg(F.min("_least").alias(key)).select(key)
    return heads.join(prints.groupBy(key).agg(F.count(F.lit(1)).alias("n")), key)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 3
) -> DataFrame:
    """``id, fingerprint (hex), component_id``, one row per row of ``docs``."""
    prints = materialize(
        docs.select(F.col(id_col).alias("_id"), fingerprint_column(F.col(text_col), shingle).alias("_print"))
    )
    nodes = materialize(prints.groupBy("_print").agg(F.min("_id").alias("_least"), F.count(F.lit(1)).alias("_rows")))
    linked = rooted(nodes, distance)
    least = linked.groupBy("_root").agg(F.min("_least").alias("component_id"))
    component = materialize(linked.join(least, "_root").select("_print", "_rows", "component_id"))
    joined = salted_join(
        prints, component.select("_print", "component_id"), "_print", hot_keys(component, "_print", "_rows"), "_id"
    )
    digits = F.lower(F.lpad(F.hex("_print"), 16, "0"))
    return joined.select(F.col("_id").alias(id_col), digits.alias("fingerprint"), "component_id")
