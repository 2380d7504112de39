"""Readers. Schemas are always given, never inferred."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.functions.text import is_blank

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("server_slug", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("input_schema", T.StringType()),
        T.StructField("category", T.StringType()),
    ]
)
SERVER_SCHEMA = "slug string, name string, description string"
SCORED_SCHEMA = (
    "record_id string, server_slug string, name string, description string, "
    "true_category string, predicted_category string, correct boolean"
)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One JSON object per line; blank lines are skipped, a bad line fails the job.

    ``ordinal`` sorts in file order: path, start of the file split, row within the split.
    It costs no shuffle, since rows of one split are read in order by one task.
    """
    raw = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return with_file_order(raw)


def read_jsonl_rejects(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """``file_path, line_no, line`` of the bad lines: where to look after a failed read.

    A line is numbered by its place in its file split plus the lines of the splits before it.
    The running sum is over splits, not over lines.
    """
    fields = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    with_bad = T.StructType([*fields.fields, T.StructField("_bad", T.StringType())])
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").alias("line"),
    )
    split_of_file = Window.partitionBy("file_path").orderBy("block")
    splits = (
        lines.groupBy("file_path", "block")
        .agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first_row"))
        .withColumn("before", F.sum("n").over(split_of_file) - F.col("n"))
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    bad = lines.filter(
        ~is_blank(F.col("line")) & F.from_json("line", with_bad, options)["_bad"].isNotNull()
    )
    return bad.join(splits, ["file_path", "block"]).select(
        "file_path",
        (F.col("before") + F.col("row") - F.col("first_row") + 1).alias("line_no"),
        "line",
    )


def with_file_order(df: DataFrame) -> DataFrame:
    order = F.struct(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return df.select(order.alias("ordinal"), *df.columns)


def _needed(name: str) -> Column:
    message = F.lit(f"{name} is missing from a record")
    return F.when(F.col(name).isNull(), F.raise_error(message)).otherwise(F.col(name)).alias(name)


def normalize_records(raw: DataFrame) -> DataFrame:
    """Ids are required; missing or null text becomes empty; the category may stay null."""
    absent = [f.name for f in RECORD_SCHEMA if f.name not in raw.columns]
    full = raw.withColumns({name: F.lit(None).cast("string") for name in absent}) if absent else raw
    extra = [c for c in raw.columns if c not in RECORD_SCHEMA.names]
    return full.select(
        *extra,
        _needed("record_id"),
        _needed("server_slug"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("name", "description", "input_schema")],
        F.col("category"),
    )


def load_records(spark: SparkSession, path: str) -> DataFrame:
    return normalize_records(read_jsonl(spark, path, RECORD_SCHEMA))


def union_splits(splits: dict[str, DataFrame]) -> DataFrame:
    """All splits as one table with a ``split`` column; a missing category column is null."""
    parts = [df.withColumn("split", F.lit(name)) for name, df in splits.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_servers(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, SERVER_SCHEMA)


def read_scored(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, SCORED_SCHEMA)
