"""Counts over the record table, per split."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayer.functions import params as P
from assayer.functions import text as X
from assayer.functions.numeric import round_half_even_1dp, share_pct
from assayer.labels import LABELS, SPLITS, label_dim, label_id
from assayer.operators.records import label_word_hits, labelled, with_content_hash
from assayer.session import keep_last_of_repeated_keys, materialize


def split_rows(records: DataFrame) -> DataFrame:
    return records.groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


def label_counts(records: DataFrame) -> DataFrame:
    return labelled(records).groupBy("split", "category").agg(F.count(F.lit(1)).alias("n"))


def missing_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("split").agg(
        F.count_if(X.is_blank(F.col("name"))).alias("missing_name"),
        F.count_if(X.is_blank(F.col("description"))).alias("missing_description"),
        F.count_if(X.is_blank(F.col("input_schema"))).alias("empty_schema"),
    )


def unparsable_counts(records: DataFrame) -> DataFrame:
    keep_last_of_repeated_keys(records.sparkSession)
    return records.groupBy("split").agg(
        F.count_if(P.is_unparsable("input_schema")).alias("unparsable_schema")
    )


def duplicate_ids(records: DataFrame) -> DataFrame:
    """Rows minus distinct ids. Ids collapse per (split, id) before the split total."""
    per_id = records.groupBy("split", "record_id").agg(F.count(F.lit(1)).alias("n"))
    return per_id.groupBy("split").agg(F.sum(F.col("n") - 1).alias("duplicate_record_ids"))


def exact_duplicates(records: DataFrame) -> DataFrame:
    """Rows minus distinct content. A group of copies collapses map-side to one row per task."""
    per_hash = (
        with_content_hash(records)
        .groupBy("split", "content_hash")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per_hash.groupBy("split").agg(F.sum(F.col("n") - 1).alias("exact_duplicates"))


def distinct_groups(records: DataFrame) -> DataFrame:
    return records.groupBy("split").agg(F.count_distinct("server_slug").alias("servers"))


def sorted_groups(records: DataFrame) -> DataFrame:
    """Ascending distinct groups per split, range-partitioned (no single sorting task)."""
    return records.select("split", "server_slug").distinct().orderBy("split", "server_slug")


def length_stats(lengths: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Min, max and mean per split of each integer column in ``measures``."""
    return lengths.groupBy("split").agg(*[c for m in measures for c in _length_aggs(m)])


def _length_aggs(measure: str) -> list[Column]:
    return [
        F.coalesce(F.min(measure), F.lit(0)).alias(f"{measure}_min"),
        F.coalesce(F.max(measure), F.lit(0)).alias(f"{measure}_max"),
        F.coalesce(F.avg(measure), F.lit(0.0)).alias(f"{measure}_mean"),
    ]


def audit_columns(records: DataFrame) -> DataFrame:
    """The narrow row the audit aggregates: flags, lengths and keys; no text leaves the scan.

    The schema text is parsed once per row: the rendered list tells both the text length and
    whether the schema was unparsable. White space is collapsed once per text, too: the hash,
    the shown description and the blank flags all come from the collapsed text.
    """
    keep_last_of_repeated_keys(records.sparkSession)
    collapsed = records.withColumns({
        "_params": P.render_params("input_schema"),
        "_name": X.collapse_ws(F.coalesce("name", F.lit(""))),
        "_description": X.collapse_ws(F.coalesce("description", F.lit(""))),
    })
    shown = F.when(F.col("_description") == "", F.lit(X.NO_DESCRIPTION)).otherwise(
        X.truncate(F.col("_description"), X.DESCRIPTION_CHARS)
    )
    text = X.compose_text(X.name_or_default(F.col("name")), shown, F.col("_params"))
    return collapsed.select(
        "split",
        "server_slug",
        "record_id",
        F.unhex(X.hash_normalised(F.col("_name"), F.col("_description"))).alias("content"),
        (F.col("_name") == "").alias("no_name"),
        (F.col("_description") == "").alias("no_description"),
        X.is_blank(F.col("input_schema")).alias("no_schema"),
        (F.col("_params") == P.UNPARSABLE).alias("bad_schema"),
        X.char_length(F.col("description")).alias("description_chars"),
        X.char_length(text).alias("input_text_chars"),
    )


def key_facts(rows: DataFrame, key: str, splits: Sequence[str] = SPLITS) -> DataFrame:
    """One row: ``distinct`` keys per split and ``shared`` keys per pair of splits, as arrays.

    Each key collapses map-side to its row count per split, so a key that fills a third of the
    table costs one row per task, and every question about keys is answered by one shuffle.
    """
    per_key = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.count_if(F.col("split") == s).alias(f"_{i}") for i, s in enumerate(splits)]
    )
    has = [F.col(f"_{i}") > 0 for i in range(len(splits))]
    distinct = [F.count_if(has[i]) for i in range(len(splits))]
    shared = [
        F.struct(
            F.lit(f"{splits[i]}_vs_{splits[j]}").alias("pair"), F.count_if(has[i] & has[j]).alias("overlap")
        )
        for i, j in combinations(range(len(splits)), 2)
    ]
    return per_key.agg(
        F.array(*[F.struct(F.lit(s).alias("split"), n.alias("n")) for s, n in zip(splits, distinct)]).alias("distinct"),
        (F.array(*shared) if shared else F.array()).alias("shared"),
    )


def audit_rows(
    narrow: DataFrame, splits: Sequence[str], servers: DataFrame, contents: DataFrame
) -> DataFrame:
    """One row per split asked for, from :func:`audit_columns` rows and the facts of two keys."""
    rows = F.count(F.lit(1))
    counters = narrow.groupBy("split").agg(
        rows.alias("rows"),
        F.count_if("no_name").alias("missing_name"),
        F.count_if("no_description").alias("missing_description"),
        F.count_if("no_schema").alias("empty_schema"),
        F.count_if("bad_schema").alias("unparsable_schema"),
        *_length_aggs("description_chars"),
        *_length_aggs("input_text_chars"),
    )
    asked = narrow.sparkSession.createDataFrame([(s,) for s in splits], "split string")
    out = asked.join(F.broadcast(counters), "split", "left")
    ids = key_facts(narrow, "record_id", splits)
    for name, facts in (("_servers", servers), ("_ids", ids), ("_contents", contents)):
        per_split = facts.select(F.explode("distinct").alias("f")).select("f.split", F.col("f.n").alias(name))
        # One row per split on both sides.
        out = out.join(F.broadcast(per_split), "split", "left")
    n = F.coalesce("rows", F.lit(0))
    zero = [c for c in counters.columns if c not in ("split", "rows")]
    return out.select(
        "split",
        n.alias("rows"),
        F.col("_servers").alias("servers"),
        *[F.coalesce(c, F.lit(0.0 if c.endswith("_mean") else 0)).alias(c) for c in zero[:4]],
        (n - F.col("_ids")).alias("duplicate_record_ids"),
        (n - F.col("_contents")).alias("exact_duplicates"),
        *[F.coalesce(c, F.lit(0.0 if c.endswith("_mean") else 0)).alias(c) for c in zero[4:]],
    )


def audit_splits(records: DataFrame, splits: Sequence[str] = SPLITS) -> DataFrame:
    """One row per split asked for with every counter; a split without records counts zeros.

    The records are scanned once. Their narrow rows are checkpointed, since each kind of key is
    counted by an aggregate of its own, which combines map-side.
    """
    narrow = materialize(audit_columns(records.filter(F.col("split").isin(*splits))))
    return audit_rows(narrow, splits, key_facts(narrow, "server_slug", splits), key_facts(narrow, "content", splits))


def label_share(
    records: DataFrame, splits: Sequence[str] = SPLITS, labels: Sequence[str] = LABELS
) -> DataFrame:
    """Every label of the set with its count and percent per split, 0 when absent.

    The counts are one partial aggregate to ``len(labels) * len(splits)`` numbers; the
    percent is of the labelled rows of that split and null when there are none.
    """
    id_col = label_id(F.col("category"), labels)
    counts = (
        labelled(records)
        .select("split", id_col.alias("label_id"))
        .groupBy("label_id")
        .pivot("split", list(splits))
        .agg(F.count(F.lit(1)))
    )
    dim = F.broadcast(label_dim(records.sparkSession, labels))
    filled = dim.join(counts, "label_id", "left").select(
        "label_id", "label", *[F.coalesce(s, F.lit(0)).alias(s) for s in splits]
    )
    # len(labels) rows: one partition is the right size.
    whole = Window.partitionBy(F.lit(0))
    return filled.select(
        "label_id",
        "label",
        *[F.col(s).alias(f"{s}_n") for s in splits],
        *[
            round_half_even_1dp(share_pct(F.col(s), F.sum(s).over(whole))).alias(f"{s}_pct")
            for s in splits
        ],
    )


def imbalance_ratio(records: DataFrame) -> DataFrame:
    """Largest over smallest label count per split, over the labels that occur."""
    return label_counts(records).groupBy("split").agg(
        (F.max("n").cast("double") / F.min("n").cast("double")).alias("imbalance_ratio")
    )


def rare_share(records: DataFrame, rarest: int = 2) -> DataFrame:
    """Percent of labelled rows in the ``rarest`` smallest labels of each split."""
    counts = label_counts(records)
    order = Window.partitionBy("split").orderBy("n", label_id(F.col("category")))
    ranked = counts.withColumn("rank", F.row_number().over(order))
    return ranked.groupBy("split").agg(
        share_pct(F.sum(F.when(F.col("rank") <= rarest, F.col("n")).otherwise(0)), F.sum("n")).alias(
            "rare_pct"
        )
    )


def label_word_scan(servers: DataFrame) -> DataFrame:
    hits = label_word_hits(servers)
    return hits.agg(
        F.count(F.lit(1)).alias("rows_scanned"),
        F.count_if(F.size("matched") > 0).alias("rows_with_label_word"),
    )


def first_hits(servers: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows with a label word, in file order (distributed top-k)."""
    hits = label_word_hits(servers).filter(F.size("matched") > 0)
    return hits.select("ordinal", "slug", "matched").orderBy("ordinal").limit(n)


def length_percentiles(
    lengths: DataFrame, length_col: str, limit: int | Column, by: Sequence[str] = ()
) -> DataFrame:
    """Exact p95, p99 and the share of rows within ``limit``, per group of ``by``.

    Equal lengths are counted first, so what reaches the last task is bounded by the
    number of different lengths and not by the number of rows.
    """
    bound = limit if isinstance(limit, Column) else F.lit(limit)
    per_length = lengths.groupBy(*by, F.col(length_col).alias("length"), bound.alias("_limit")).agg(
        F.count(F.lit(1)).alias("n")
    )
    points = F.expr("percentile(length, array(0.95D, 0.99D), n)")
    within = F.sum(F.when(F.col("length") <= F.col("_limit"), F.col("n")).otherwise(0))
    return per_length.groupBy(*by).agg(
        points.alias("p"), F.sum("n").alias("rows"), within.alias("within")
    ).select(
        *by,
        "rows",
        F.get("p", F.lit(0)).alias("p95"),
        F.get("p", F.lit(1)).alias("p99"),
        F.try_divide(F.col("within").cast("double"), F.col("rows").cast("double")).alias("share_within"),
    )


# Entries a quantile sketch keeps per level. Its rank error falls as 2.3 / k^0.97.
SKETCH_K = 2048


def rank_error(k: int = SKETCH_K) -> float:
    """How far, with 99 % certainty, the rank of a sketched percentile lies from the one asked for."""
    return 2.296 / k**0.9723


def length_sketches(
    lengths: DataFrame, length_col: str, limit: int | Column, by: Sequence[str] = (), k: int = SKETCH_K
) -> DataFrame:
    """``by, rows, within, sketch``: a few kilobytes per group that stand for its lengths.

    States of several batches, splits or days are put together by :func:`sketched_percentiles`; no
    batch is read again. Null lengths count as rows and are in no percentile.
    """
    bound = limit if isinstance(limit, Column) else F.lit(limit)
    length = F.col(length_col).cast("bigint")
    return lengths.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(length <= bound).alias("within"),
        F.kll_sketch_agg_bigint(length, F.lit(k)).alias("sketch"),
    )


def sketched_percentiles(states: DataFrame, by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """``by, rows, p95, p99, share_within`` of merged states; the percentiles are lengths that occur.

    Beside :func:`length_percentiles`, which is exact and shuffles every different length: here each
    task sends one sketch a group, and ranks are off by :func:`rank_error` at most.
    """
    merged = states.groupBy(*by).agg(
        F.sum("rows").alias("rows"), F.sum("within").alias("within"), F.kll_merge_agg_bigint("sketch", F.lit(k)).alias("sketch")
    )
    known = F.kll_sketch_get_n_bigint("sketch") > 0
    return merged.select(
        *by, "rows",
        *[F.when(known, F.kll_sketch_get_quantile_bigint("sketch", F.lit(q))).alias(name) for name, q in (("p95", 0.95), ("p99", 0.99))],
        F.try_divide(F.col("within").cast("double"), F.col("rows").cast("double")).alias("share_within"),
    )
