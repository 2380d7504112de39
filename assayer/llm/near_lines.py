"""Lines of high edit similarity, in DataFrame operations only.

Lines meet on keys, and every pair that meets may be verified by its edit distance. There is no
cap on the lines of a key.

Lines of at least ``SHORT`` characters have the character shingles of their normal form hashed,
and the least value of every ``hash xor constant`` kept: for any constant two lines agree with a
probability equal to the Jaccard similarity of their shingles. A key is a choice of three such
values. The README states the share of similar pairs that meet.

Shorter lines meet with certainty. A line within ``t`` edits of another contains one of the
other's ``t + 1`` segments whole, near its place (partition join with the multi-match windows). So
every short line files its segments, and every line that may be as close looks them up.
"""

from __future__ import annotations

import json
import random
from collections.abc import Callable
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.bitmaps import bitmap, flagged
from assayer.llm.components import connected_components
from assayer.session import materialize

SHORT = 40
VALUES = 16
KEYS = 32
_rng = random.Random(16)
CONSTANTS = [_rng.getrandbits(32) - (1 << 31) for _ in range(VALUES)]
CHOICES = _rng.sample(list(combinations(range(VALUES), 3)), KEYS)
BOTH, FILED, LOOKED_UP = 0, 1, 2


def limit(length: int, share: float) -> int:
    """The edits allowed to two lines, the longer one of ``length`` characters."""
    return int(length * share + 1e-9)


def plan(share: float) -> list[tuple[int, int, int, int, int, int, int]]:
    """``len, role, other, edits, segment, start, size``: the substrings that a line of ``len`` takes part with.

    Starts count from 1. ``other`` is the length of the line that files.
    """
    out = set()
    for longer in range(1, SHORT * 2):
        t = limit(longer, share)
        for own in range(max(1, longer - t), min(longer, SHORT - 1) + 1):
            at, gap = 0, longer - own
            for i in range(t + 1) if t else ():
                size = own // (t + 1) + (i >= t + 1 - own % (t + 1))
                out.add((own, FILED, own, t, i, at + 1, size))
                low, high = max(at - i, at + gap - (t - i), 0), min(at + i, at + gap + (t - i), longer - size)
                out |= {(longer, LOOKED_UP, own, t, i, p + 1, size) for p in range(low, high + 1)}
                at += size
    return sorted(out)


def _short_keys(lines: DataFrame, share: float, stored: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``key, node, len, role`` of short lines, and of longer ones that a short one may be like."""
    fields = ["_len", "role", "other", "edits", "segment", "start", "size"]
    rows = plan(share)
    longest = max((r[0] for r in rows), default=0)
    table = lines.sparkSession.range(1).select(
        F.explode(F.from_json(F.lit(json.dumps([dict(zip(fields, r)) for r in rows])),
                              f"array<struct<{','.join(f'{f}:int' for f in fields)}>>")).alias("_p")
    ).select("_p.*")
    few = lines.select("k1", "k2", "len", F.explode(F.when(F.col("len") <= longest, F.array("norm"))).alias("norm"))
    short = stored(few.distinct())
    piece = F.substring("norm", F.col("start"), F.col("size"))
    key = F.xxhash64(F.lit(-1), "other", "edits", "segment", piece)
    return short.join(F.broadcast(table), F.col("len") == F.col("_len")).select(
        key.alias("key"), F.struct("k1", "k2").alias("node"), "len", "role"
    )


def _long_keys(lines: DataFrame, shingle: int, stored: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``key, node, len, role`` of the other lines."""
    every = F.regexp_extract_all("norm", F.lit(f"(?=(.{{{shingle}}}))"), F.lit(1))
    hashes = lines.select("k1", "k2", "len", F.explode(F.when(F.col("len") >= SHORT, every)).alias("_s")).select(
        "k1", "k2", "len", F.shiftright(F.xxhash64("_s"), 32).cast("int").alias("_h")
    )
    least = [F.min(F.col("_h").bitwiseXOR(F.lit(c).cast("int"))).alias(f"m{i}") for i, c in enumerate(CONSTANTS)]
    sketches = stored(hashes.groupBy("k1", "k2", "len").agg(*least))
    keys = [F.xxhash64(F.lit(j), *[f"m{i}" for i in chosen]) for j, chosen in enumerate(CHOICES)]
    return sketches.select(
        F.explode(F.array(*keys)).alias("key"), F.struct("k1", "k2").alias("node"), "len", F.lit(BOTH).alias("role")
    )


def members(
    lines: DataFrame, shingle: int, share: float, stored: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``key, node, len, role`` of the keys on which different lines meet, of rows ``k1, k2, len, norm``."""
    keyed = _long_keys(lines, shingle, stored).unionByName(_short_keys(lines, share, stored))
    # Keys are counted without their lines; a bitmap then keeps nearly all single lines out of the second shuffle.
    repeated = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    bits = bitmap(repeated, "key")
    some = stored(flagged(keyed, F.col("key"), bits, "_may").filter("_may").drop("_may"))
    met = some.groupBy("key").agg(
        F.min("node").alias("hub"), F.max("node").alias("_last"),
        F.bool_or(F.col("role") != LOOKED_UP).alias("_filed"), F.bool_or(F.col("role") != FILED).alias("_looked"),
    ).filter("hub <> _last and _filed and _looked")
    return stored(some.join(met.select("key", "hub"), "key"))


def _may_match(share: float) -> Column:
    longer, shorter = F.greatest("la", "lb"), F.least("la", "lb")
    return longer - shorter <= F.floor(longer * F.lit(share) + F.lit(1e-9))


def groups(
    members: DataFrame, texts: DataFrame, share: float, similar: Callable[[str, str], Column]
) -> DataFrame:
    """``node, root`` of the groups that verified links make.

    As comparing all lines of a key would cost the square of a large group of near copies, every
    line is first compared with the least line of its key. Then only lines of a key that are still
    in different groups are compared, all of them: a link within a group would change nothing.
    """

    def verified(pairs: DataFrame) -> DataFrame:
        one = texts.select(F.col("node").alias("na"), F.col("norm").alias("ta"))
        two = texts.select(F.col("node").alias("nb"), F.col("norm").alias("tb"))
        return materialize(pairs.join(one, "na").join(two, "nb").filter(similar("ta", "tb")).select("na", "nb"))

    hubs = members.filter("node = hub").select("key", F.col("len").alias("lb")).distinct()
    near = members.filter("node <> hub").join(hubs, "key").withColumnRenamed("len", "la").filter(_may_match(share))
    links = verified(near.select(F.col("node").alias("na"), F.col("hub").alias("nb")).distinct())
    found = connected_components(links, "na", "nb")
    # A pair with the hub has been compared, but the hub's own group goes on.
    own = members.join(found, "node", "left").withColumn("group", F.coalesce("root", "node")).drop("root")
    sizes = own.groupBy("key").agg(F.min("group").alias("_least"), F.max("group").alias("_most"))
    apart = materialize(own.join(sizes.filter("_least <> _most").select("key"), "key", "left_semi"))
    left = apart.filter(F.col("role") != LOOKED_UP).select(
        "key", "hub", F.col("node").alias("na"), F.col("len").alias("la"), F.col("group").alias("ga"), F.col("role").alias("ra")
    )
    right = apart.filter(F.col("role") != FILED).select(
        "key", F.col("node").alias("nb"), F.col("len").alias("lb"), F.col("group").alias("gb")
    )
    new = (F.col("na") != F.col("hub")) & (F.col("nb") != F.col("hub")) & (F.col("ga") != F.col("gb"))
    once = (F.col("ra") != BOTH) | (F.col("na") < F.col("nb"))
    rest = left.join(right, "key").filter(new & once & _may_match(share))
    more = verified(rest.select(F.least("na", "nb").alias("na"), F.greatest("na", "nb").alias("nb")).distinct())
    return connected_components(links.unionByName(more), "na", "nb")
