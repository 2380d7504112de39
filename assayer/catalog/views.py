"""Record-like views over the given tables.

The column expressions are plain SQL that Spark and DuckDB read alike, so both engines
start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SPLIT = (
    "case when cast(substr(source, 4) as int) < 14 then 'train'"
    " when cast(substr(source, 4) as int) < 17 then 'validation' else 'test' end"
)

_FOURTEEN = ",".join(
    f'"p{i}":{{"type":"{kind}","description":"\', repeat(\'step {i} \', {5 * i}), \'"}}'
    for i, kind in enumerate(["string", "integer", "boolean", "number"] * 3 + ["array", "object"], 1)
)

# What each input_schema looks like, by doc_id % 11.
_SCHEMA = f"""case doc_id % 11
 when 0 then ''
 when 1 then case doc_id % 55 when 1 then '{{"a":' when 12 then '{{}},{{}}]'
   when 23 then '{{"properties":{{"a":{{}}}},{{}}] junk' when 34 then '{{}},{{}}] [1'
   else concat('{{"a":1}}', chr(10), ',{{"b":2}}]') end
 when 2 then '[1]'
 when 3 then '{{}}'
 when 4 then concat('{{"properties":{{{_FOURTEEN}}},"required":["p2","p13"]}}')
 when 5 then concat('{{"type":"object","properties":{{"mode_', cast(doc_id as string),
   '":{{"type":["string","null"],"enum":["a1","b2",3,true,null,"f6","g7","h8"],',
   '"description":"  pick   one of ', lang, '  "}}}},"required":[]}}')
 when 6 then concat('{{"required":null,"properties":{{"target":{{"anyOf":[{{"type":"string"}}]}},',
   '"free":{{}},"note":{{"description":', cast(doc_id as string), '}},"flag":true,',
   '"choice":{{"type":null,"enum":[]}},"many":{{"oneOf":[1.5],"description":" "}},',
   '"size":{{"enum":[1e20,0.00001,2.50,-1.5e-7,1e16,0.0]}}}}}}')
 when 7 then '{{"properties":{{}},"required":["x"]}}'
 else concat('{{"type":"object","properties":{{"id_', cast(doc_id as string),
   '":{{"type":"integer","description":"row ', cast(doc_id as string), ' in ', lang,
   '"}},"lang":{{"type":"string","enum":["en","fr","de","es"]}}}},"required":["id_',
   cast(doc_id as string), '"]}}') end"""

_LABEL = (
    f"case when {_SPLIT} = 'test' then null when doc_id % 97 = 0 then 'Financial'"
    " when lang = 'en' then 'Read' when lang = 'fr' then 'Write'"
    " when lang = 'de' then 'Execute' else 'Destructive' end"
)

REC_COLUMNS = {
    "ordinal": "doc_id",
    "record_id": "cast(doc_id as string)",
    "server_slug": "source",
    "split": _SPLIT,
    "name": "case when doc_id % 53 = 0 then '   ' else concat(lang, '_tool') end",
    "description": "case when doc_id % 29 = 0 then '' else text end",
    "input_schema": _SCHEMA,
    "category": _LABEL,
}

SERVER_COLUMNS = {
    "ordinal": "doc_id",
    "slug": "source",
    "name": "concat(lang, '_tool')",
    "description": "text",
}

# A rule that guesses the label from one frequent word.
RULE = (
    "case when contains(lower(text), ' der ') then 'Execute'"
    " when contains(lower(text), ' les ') then 'Write'"
    " when contains(lower(text), ' los ') then 'Destructive' else 'Read' end"
)

# One score per label, in id order: how often a frequent word occurs.
SCORE_WORDS = (" the ", " les ", " der ", " los ", " invoice ", " zzz ")
SCORES = [
    f"cast((length(lower(text)) - length(replace(lower(text), '{w}', ''))) / {len(w)}.0 as double)"
    for w in SCORE_WORDS
]

# A noisy variant of the rule, for the label guard: some rows get a word that is no label.
NOISY_RULE = (
    f"case when doc_id % 31 = 0 then 'Maybe' when doc_id % 37 = 0 then lower(lang) else {RULE} end"
)


def _sql(columns: dict[str, str], table: str) -> str:
    return f"select {', '.join(f'{e} as {n}' for n, e in columns.items())} from {table}"


REC_SQL = _sql(REC_COLUMNS, "documents")
SERVER_SQL = _sql(SERVER_COLUMNS, "documents")
# Some records have no prediction at all.
PRED_COLUMNS = {**REC_COLUMNS, "predicted_category": f"case when doc_id % 41 = 0 then null else {RULE} end"}
PRED_SQL = f"select * from ({_sql(PRED_COLUMNS, 'documents')}) t where category is not null"
EPOCHS_SQL = (
    "select run, epoch, avg(value) / 100 as macro_f1 from ("
    "select event_type as run, cast(extract(day from ts) as bigint) as epoch, value from events) t"
    " group by run, epoch"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(e).alias(n) for n, e in columns.items()])


def rec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record table."""
    return _select(table(spark, sf_dir, "documents"), REC_COLUMNS)


def servers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "documents"), SERVER_COLUMNS)


def pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled records with the rule's prediction."""
    rows = _select(table(spark, sf_dir, "documents"), PRED_COLUMNS)
    return rows.filter(F.col("category").isNotNull())


def noisy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with a prediction that is sometimes no label."""
    return _select(
        table(spark, sf_dir, "documents"), {**REC_COLUMNS, "predicted_category": NOISY_RULE}
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with one score per label."""
    return _select(
        table(spark, sf_dir, "documents"),
        {**REC_COLUMNS, "scores": f"array({', '.join(SCORES)})"},
    )


def epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run history per event type: one evaluation per day, its score the day's mean value."""
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("run"), F.dayofmonth("ts").cast("bigint").alias("epoch"), "value"
    )
    return events.groupBy("run", "epoch").agg((F.avg("value") / 100).alias("macro_f1"))


def spread(scan: DataFrame) -> DataFrame:
    """Use all cores for CPU-heavy work on a scanned table that arrives in few partitions.

    Serves the small test tables only, whose single row group is read by one task however many
    cores there are; the engine itself never calls it.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
