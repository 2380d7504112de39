"""Fuzzy line dedup, in DataFrame operations only.

Lines are the parts of a text between line feeds. A line is normalised to lower case, without
white space at its ends and with one space for several; with ``letters`` to its lower-case runs of
letters, marks and digits, joined by spaces, unless it has none. Lines of white space always stay. Lines with equal normal forms are copies. Lines of at least
``min_words`` words also match if the SimHashes of their different words differ in at most ``distance`` of
64 bits and the edit similarity of their normal forms is at least ``similarity``. Of every
connected group the occurrence with the least (id, line number) stays; all others are removed.

Candidates come from pigeonhole blocks: 64 bits in ``blocks`` blocks, of which ``distance`` can
differ, so that pairs agree on some ``blocks - distance`` whole blocks. Rows meet on those blocks
only, after equal lines and equal SimHashes have been merged, so copies are never paired. There
is no cap on a block's rows. With ``shingle``, as in ``WHOLE``, candidates of any length come from
:mod:`near_lines` instead, which replaces ``min_words``, ``distance`` and ``blocks``.

A null text stays null and an empty one empty. Rows with a null id come first, and repeated rows
are separate occurrences, so that only one of them keeps its lines. An empty table gives an empty
result. Extra columns of any name are kept as they are.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.functions.binding import let
from assayer.llm import near_lines
from assayer.llm.bitmaps import bitmap, flagged
from assayer.llm.components import connected_components
from assayer.operators.skew import hot_keys, salted_join
from assayer.session import ensure_checkpoint_dir, materialize


@dataclass(frozen=True)
class LineDedupConfig:
    min_words: int = 5
    similarity: float = 0.8
    distance: int = 3
    blocks: int = 5
    letters: bool = False
    reach: int = 3  # pairs that meet on a block key are verified up to so many bits, at least ``distance``
    shingle: int = 0  # with a length, candidates come from near_lines instead of SimHashes


#: What the queries run: copies may differ in punctuation, quotes and any white space.
WHOLE = LineDedupConfig(letters=True, shingle=8)

#: The same by the SimHashes of words, as the queries run it.
SIMHASH = LineDedupConfig(letters=True, reach=12)

RUN = 16_383  # words whose bits can be counted in lanes of sixteen bits
_LANES = 0x0001_0001_0001_0001


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def line_words(line: Column) -> Column:
    """The normalised words of a line: what lies between spaces, in lower case."""
    return F.array_remove(F.split(F.lower(F.trim(line, F.lit(" \t\r"))), " ", -1), "")


def line_norm(line: Column, config: LineDedupConfig) -> Column:
    """The normal form of a line; empty only for a line of spaces, tabs and carriage returns."""
    spaced = F.array_join(line_words(line), " ")
    if not config.letters:
        return spaced
    # A combining mark is part of its letter. A line of signs only, such as a rule, stays as it is.
    letters = F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{M}\p{N}]+", " "))
    return F.coalesce(F.nullif(letters, F.lit("")), spaced)


def line_simhashes(words: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, n, simhash`` of rows ``keys, words``; rows without words disappear.

    Bit b of a SimHash is 1 if it is set in over half of the hashes of the ``n`` different words;
    counted with their frequencies, long lines of one language would all look alike. The 64 counters
    are lanes of 16 longs, four in each, so that one aggregate of 16 sums counts them. Adding
    ``2^14 - 1 - n div 2`` to a lane sets its bit 14 exactly if its count is over ``n / 2``.
    Lanes hold up to 16,383 different words; the sums of longer lines are added up in wider ones.

    Rows are grouped by a number of their own, so that equal rows stay apart and no group is larger than
    its line; the keys ride along as greatest values, which are hashed once a line, not once a word.
    """
    numbered = words.select(
        F.monotonically_increasing_id().alias("_line"), *keys,
        F.array_distinct(F.transform("words", lambda w: F.xxhash64(w))).alias("_hashes"),
    )
    each = numbered.select(
        "_line", *keys, F.size("_hashes").alias("n"), F.posexplode("_hashes").alias("_at", "_h")
    ).select("_line", *keys, "n", F.expr(f"_at div {RUN}").alias("_run"), "_h")
    lane = lambda i: F.shiftrightunsigned("_h", i).bitwiseAND(_long(_LANES))
    sums = each.groupBy("_line", "_run").agg(
        *[F.max(F.col(c)).alias(c) for c in keys], F.max("n").alias("n"),
        *[F.sum(lane(i)).alias(f"_c{i}") for i in range(16)],
    )
    lift = (_long((1 << 14) - 1) - F.floor(F.col("n") / F.lit(2)).cast("long")) * _long(_LANES)
    bits = None
    for i in range(16):
        over = F.shiftrightunsigned(F.col(f"_c{i}") + lift, 14).bitwiseAND(_long(_LANES))
        term = F.shiftleft(over, i)
        bits = term if bits is None else bits.bitwiseOR(term)
    counted = F.array(*[f"_c{i}" for i in range(16)])
    whole = F.col("n") <= RUN
    table = stored(
        sums.select("_line", *keys, "n", F.when(whole, bits).alias("simhash"), F.when(~whole, counted).alias("_counts"))
    )
    # Bit 16 j + i is in lane j of count i.
    wide = lambda b: F.shiftrightunsigned(F.get("_counts", F.lit(b % 16)), 16 * (b // 16)).bitwiseAND(32767)
    long_lines = table.filter("simhash is null").groupBy("_line").agg(
        *[F.max(F.col(c)).alias(c) for c in (*keys, "n")], *[F.sum(wide(b)).alias(f"_b{b}") for b in range(64)]
    )
    value = None
    for b in range(64):
        mask = (1 << b) - (1 << 64 if b == 63 else 0)
        term = F.when(F.col(f"_b{b}") * 2 > F.col("n"), _long(mask)).otherwise(_long(0))
        value = term if value is None else value.bitwiseOR(term)
    return table.filter("simhash is not null").drop("_counts", "_line").unionByName(
        long_lines.select(*keys, "n", value.alias("simhash"))
    )


def _block_keys(simhash: Column, config: LineDedupConfig) -> list[Column]:
    """One key for every choice of blocks on which a pair may agree.

    The bits outside the chosen blocks hold a mark of the choice, so that keys of different
    choices differ.
    """
    edges = [64 * i // config.blocks for i in range(config.blocks + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    out = []
    for number, chosen in enumerate(combinations(blocks, config.blocks - config.distance), 1):
        mask = sum(chosen)
        mark = sum(number << k for k in range(0, 64, 8)) & ((1 << 64) - 1) & ~mask
        out.append(simhash.bitwiseAND(_long(signed(mask))).bitwiseOR(_long(signed(mark))))
    return out


def _near(a: str, b: str, config: LineDedupConfig) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max(config.reach, config.distance)


def met_keys(distinct: DataFrame, config: LineDedupConfig) -> DataFrame:
    """``key, simhash``: the block keys on which a SimHash meets another one near enough, stored.

    All SimHashes at most ``distance`` bits apart meet, and those up to ``reach`` bits apart that
    agree on enough blocks all the same. No pairs come out, so a hot key costs no more than its rows.
    """
    keyed = distinct.select("simhash", F.explode(F.array(*_block_keys(F.col("simhash"), config))).alias("key"))
    other = keyed.select(F.col("key").alias("_key"), F.col("simhash").alias("_other"))
    meets = (F.col("key") == F.col("_key")) & (F.col("simhash") != F.col("_other")) & _near("simhash", "_other", config)
    return stored(keyed.join(other, meets, "left_semi"))


def _similar(a: str, b: str, config: LineDedupConfig) -> Column:
    """Whether two lines have the edit similarity asked for.

    The cost of a bounded edit distance follows its bound, so small bounds are tried first.
    """
    limit = f"cast(floor(greatest(length({a}), length({b})) * {1 - config.similarity!r} + 1e-9) as int)"
    within = lambda bound: f"levenshtein({a}, {b}, {bound}) >= 0"
    steps = "".join(
        f" when {within(f'least({bound}, {limit})')} then true when {limit} <= {bound} then false"
        for bound in (16, 64, 256, 1024, 4096, 16384)
    )
    return F.expr(f"case when abs(length({a}) - length({b})) > {limit} then false{steps} else {within(limit)} end")


def _coded(norm: Column) -> Column:
    """``text, code, most``: a normal form, the same with one character for every word, and its longest word.

    A word's character is one of 2^20, chosen by its hash.
    """
    words = F.split(norm, " ", -1)
    unit = lambda w: F.lpad(F.hex(F.pmod(F.xxhash64(w), _long(1 << 20)) + _long(1 << 16)), 8, "0")
    code = F.decode(F.unhex(F.array_join(F.transform(words, unit), "")), "UTF-32")
    return F.struct(norm.alias("text"), code.alias("code"), F.array_max(F.transform(words, F.length)).alias("most"))


def _similar_coded(a: str, b: str, config: LineDedupConfig) -> Column:
    """:func:`_similar` of two forms by :func:`_coded`.

    An edit of words costs at most the longest word and a space in characters. So few enough edits of
    words prove the similarity, at a fraction of the cells; all other pairs are compared by characters.
    """
    limit = f"floor(greatest(length({a}.text), length({b}.text)) * {1 - config.similarity!r} + 1e-9)"
    few = f"cast({limit} div (greatest({a}.most, {b}.most) + 1) as int)"
    close = F.expr(f"abs(length({a}.text) - length({b}.text)) <= {limit}")
    return close & (F.expr(f"levenshtein({a}.code, {b}.code, {few}) >= 0") | _similar(f"{a}.text", f"{b}.text", config))


def stored(df: DataFrame) -> DataFrame:
    """A table written to the shared checkpoint folder and read again: it outlives executors."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def line_occurrences(docs: DataFrame, row: str, text_col: str, config: LineDedupConfig) -> DataFrame:
    """``row, line, k1, k2, simhash`` of every line that is not blank, stored.

    The keys name the normal form; lines of fewer than ``min_words`` words have no SimHash.
    """
    # A struct travels as its fields, which a hash aggregate can hold if they are of fixed width.
    kind = docs.schema[row].dataType
    fields = [f"{row}.{f}" for f in kind.names] if isinstance(kind, T.StructType) else [row]
    names = [f"_id{i}" for i in range(len(fields))]
    words = _normal_lines(docs, row, text_col, config).select(
        *[F.col(f).alias(n) for f, n in zip(fields, names)], "line",
        F.xxhash64("norm").alias("k1"), F.xxhash64(F.lit(1), "norm").alias("k2"), F.split("norm", " ", -1).alias("words"),
    ).withColumn("long", F.size("words") >= config.min_words)
    back = F.struct(*[F.col(n).alias(f) for n, f in zip(names, kind.names)]) if isinstance(kind, T.StructType) else F.col(names[0])
    return line_simhashes(words, [*names, "line", "k1", "k2", "long"]).select(
        back.alias(row), "line", "k1", "k2", F.when(F.col("long"), F.col("simhash")).alias("simhash")
    )


def similar_groups(keyed: DataFrame, texts: DataFrame, config: LineDedupConfig) -> DataFrame:
    """``node, root`` of the groups that verified links make of ``texts`` (``simhash, node, norm``, coded).

    ``keyed`` holds the SimHashes that meet on block keys. Comparing all their lines would cost the
    square of a large group of near copies, so it is done in two steps, which give the same groups.
    First, every line is compared with the least line of its SimHash, and the least lines of every
    SimHash of a key with that of the key's least SimHash. Then only lines that are still in different
    groups are compared, all of them: a link within a group would change nothing.
    """
    hubs = materialize(
        texts.groupBy("simhash").agg(F.min(F.struct("node", "norm")).alias("h")).select(
            "simhash", F.col("h.node").alias("hub"), F.col("h.norm").alias("hub_norm")
        )
    )
    own = texts.join(hubs, "simhash").filter(F.col("node") != F.col("hub")).filter(_similar_coded("norm", "hub_norm", config))
    first = hubs.select(F.col("simhash").alias("a"), F.col("hub").alias("na"), F.col("hub_norm").alias("ta"))
    second = hubs.select(F.col("simhash").alias("b"), F.col("hub").alias("nb"), F.col("hub_norm").alias("tb"))
    least = keyed.groupBy("key").agg(F.min("simhash").alias("a"))
    stars = keyed.join(least, "key").filter((F.col("simhash") != F.col("a")) & _near("simhash", "a", config))
    apart = stars.select("a", F.col("simhash").alias("b")).distinct().join(first, "a").join(second, "b").filter(_similar_coded("ta", "tb", config))
    links = materialize(
        own.select(F.col("node").alias("na"), F.col("hub").alias("nb")).unionByName(apart.select("na", "nb"))
    )
    groups = connected_components(links, "na", "nb")
    members = texts.join(groups, "node", "left").select("simhash", "node", "norm", F.coalesce("root", "node").alias("group"))
    classes = materialize(members.select("simhash", "group").distinct())
    side = lambda x: classes.select(F.col("simhash").alias(x), F.col("group").alias(f"g{x}"))
    left = keyed.withColumnRenamed("simhash", "a").join(side("a"), "a")
    right = keyed.withColumnRenamed("simhash", "b").join(side("b"), "b").withColumnRenamed("key", "_key")
    apart_still = (F.col("key") == F.col("_key")) & (F.col("a") < F.col("b")) & (F.col("ga") != F.col("gb"))
    across = left.join(right, apart_still & _near("a", "b", config)).select("a", "ga", "b", "gb").distinct()
    within = side("a").join(side("b"), (F.col("a") == F.col("b")) & (F.col("ga") < F.col("gb"))).select("a", "ga", "b", "gb")
    open_pairs = materialize(across.unionByName(within))
    if open_pairs.isEmpty():
        return groups
    one = members.select(F.col("simhash").alias("a"), F.col("group").alias("ga"), F.col("node").alias("na"), F.col("norm").alias("ta"))
    two = members.select(F.col("simhash").alias("b"), F.col("group").alias("gb"), F.col("node").alias("nb"), F.col("norm").alias("tb"))
    rest = open_pairs.join(one, ["a", "ga"]).join(two, ["b", "gb"]).filter(_similar_coded("ta", "tb", config))
    return connected_components(links.unionByName(rest.select("na", "nb")), "na", "nb")


def lines_of(docs: DataFrame, row: str, text_col: str) -> DataFrame:
    """``row, line, _raw`` of every line, blank or not."""
    return docs.select(F.col(row), F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("line", "_raw"))


def fetched_lines(docs: DataFrame, row: str, text_col: str, places: DataFrame, config: LineDedupConfig) -> DataFrame:
    """``places`` with ``norm``, the normal form of the line at ``first`` (row, line)."""
    bits = bitmap(places.select(F.xxhash64("first.row", "first.line").alias("h")), "h")
    rows = bitmap(places.select(F.xxhash64("first.row").alias("h")), "h")
    held = flagged(docs, F.xxhash64(row), rows, "_may").filter("_may").drop("_may")
    near = flagged(lines_of(held, row, text_col), F.xxhash64(F.col(row), F.col("line")), bits, "_may").filter("_may").drop("_may")
    found = near.join(places, (F.col(row) == F.col("first.row")) & (F.col("line") == F.col("first.line")))
    kept = [c for c in places.columns if c != "first"]
    return stored(found.select(*kept, line_norm(F.col("_raw"), config).alias("norm")).distinct())


def simhash_groups(docs: DataFrame, row: str, text_col: str, lines: DataFrame, config: LineDedupConfig) -> DataFrame:
    """``node, root`` of the lines that SimHashes and edit similarity link."""
    long_lines = lines.filter("simhash is not null")
    groups = long_lines.groupBy("simhash").agg(F.count(F.lit(1)).alias("n"))
    keyed = met_keys(groups.select("simhash"), config)
    # Texts are fetched for the lines that meet another only, from the row of their first occurrence.
    wanted = keyed.select("simhash").unionByName(groups.filter("n > 1").select("simhash")).distinct()
    places = stored(
        long_lines.join(wanted, "simhash", "left_semi").select("first", "simhash", F.struct("k1", "k2").alias("node"))
    )
    texts = fetched_lines(docs, row, text_col, places, config)
    return similar_groups(keyed, stored(texts.withColumn("norm", _coded(F.col("norm")))), config)


def _normal_lines(docs: DataFrame, row: str, text_col: str, config: LineDedupConfig) -> DataFrame:
    """``row, line, norm`` of every line that is not blank."""
    raw = lines_of(docs, row, text_col).filter(F.trim(F.col("_raw"), F.lit(" \t\r")) != "")
    return raw.select(row, "line", line_norm(F.col("_raw"), config).alias("norm"))


def near_groups(docs: DataFrame, row: str, text_col: str, lines: DataFrame, config: LineDedupConfig) -> DataFrame:
    """``node, root`` of the lines that shingles and edit similarity link."""
    keys = [F.xxhash64("norm").alias("k1"), F.xxhash64(F.lit(1), "norm").alias("k2"), F.length("norm").alias("len")]
    members = near_lines.members(
        _normal_lines(docs, row, text_col, config).select(*keys, "norm"), config.shingle, 1 - config.similarity, stored
    )
    wanted = members.select("node").distinct()
    places = stored(
        lines.select("first", F.struct("k1", "k2").alias("node")).join(wanted, "node", "left_semi")
    )
    texts = fetched_lines(docs, row, text_col, places, config)
    return near_lines.groups(members, texts, 1 - config.similarity, lambda a, b: _similar(a, b, config))


def removed_lines(docs: DataFrame, row: str, text_col: str, config: LineDedupConfig = LineDedupConfig()) -> DataFrame:
    """``row, line`` of every line that repeats an earlier one; ``row`` orders and names the rows."""
    key = ["k1", "k2"]
    if config.shingle:
        found = stored(
            _normal_lines(docs, row, text_col, config).select(
                row, "line", F.xxhash64("norm").alias("k1"), F.xxhash64(F.lit(1), "norm").alias("k2"),
                F.lit(None).cast("long").alias("simhash"),
            )
        )
    else:
        found = line_occurrences(docs, row, text_col, config)
    lines = stored(
        found.groupBy(*key).agg(
            F.min(F.struct(F.col(row).alias("row"), "line")).alias("first"),
            F.count(F.lit(1)).alias("n"),
            F.max("simhash").alias("simhash"),
        )
    )
    linked = near_groups if config.shingle else simhash_groups
    fuzzy_groups = linked(docs, row, text_col, lines, config).select("node.k1", "node.k2", "root")
    grouped = lines.join(fuzzy_groups, key, "left")
    # The occurrence that stays: of the line itself, or of its fuzzy group.
    fuzzy = grouped.filter("root is not null")
    kept = fuzzy.groupBy("root").agg(F.min("first").alias("kept"))
    decided = materialize(
        fuzzy.join(kept, "root").select(F.struct(*key).alias("_key"), "n", "kept").unionByName(
            grouped.filter("root is null and n > 1").select(F.struct(*key).alias("_key"), "n", F.col("first").alias("kept"))
        )
    )
    occurrences = found.select(row, "line", F.struct(*key).alias("_key"))
    joined = salted_join(occurrences, decided.select("_key", "kept"), "_key", hot_keys(decided, "_key", "n"), row)
    return joined.filter(F.struct(F.col(row).alias("row"), "line") != F.col("kept")).select(row, "line")


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", config: LineDedupConfig = LineDedupConfig(),
    removed_col: str | None = None,
) -> DataFrame:
    """``docs`` with every repeated line taken out of its text.

    With ``removed_col`` the number of removed lines is added under that name.
    """
    columns = docs.columns
    # A row is named by its id and a digest of its text.
    named = docs.select(
        F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("h")).alias("_row"),
        F.col(text_col).alias("_text"),
        F.struct(*[F.col(c) for c in columns if c != text_col]).alias("_rest"),
    )
    drops = removed_lines(named, "_row", "_text", config).groupBy("_row").agg(F.collect_set("line").alias("_drop"))
    repeated = named.groupBy("_row").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("_row")
    # Only rows that lose a line or repeat are shuffled; all others pass as they are.
    changes = stored(drops.join(repeated, "_row", "full"))
    bits = bitmap(changes.select(F.xxhash64("_row").alias("h")), "h")
    marked = flagged(named, F.xxhash64("_row"), bits, "_may")
    again = F.row_number().over(Window.partitionBy("_row").orderBy("_row"))
    joined = marked.filter("_may").join(changes, "_row", "left").withColumn("_again", again)
    same = marked.filter("not _may").select(
        *[F.col("_text").alias(c) if c == text_col else F.col(f"_rest.`{c}`").alias(c) for c in columns],
        *([F.lit(0).alias(removed_col)] if removed_col else []),
    )
    lines = F.split("_text", "\n", -1)
    # A repeated row keeps its blank lines only; any other row loses the lines found above.
    blank = F.filter(lines, lambda x: F.size(line_words(x)) == 0)
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "_drop")
    kept = let(lines, lambda ls: F.transform(stay, lambda i: F.get(ls, i)))
    text = (
        F.when(F.col("_again") > 1, F.array_join(blank, "\n"))
        .when(F.col("_drop").isNotNull(), F.array_join(kept, "\n"))
        .otherwise(F.col("_text"))
    )
    gone = F.when(F.col("_again") > 1, F.size(lines) - F.size(blank)).otherwise(F.coalesce(F.size("_drop"), F.lit(0)))
    out = [text.alias(c) if c == text_col else F.col(f"_rest.`{c}`").alias(c) for c in columns]
    if removed_col:
        out.append(F.coalesce(gone, F.lit(0)).cast("int").alias(removed_col))
    return joined.select(*out).unionByName(same)
