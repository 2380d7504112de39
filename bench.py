"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Every query runs to the end into a sink that drops its rows, so nothing is pruned away or
collected. ``rows_per_second`` is batch throughput over the whole record table.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from assayer.catalog import views  # noqa: E402
from assayer.catalog.queries import QUERIES, train_model  # noqa: E402
from assayer.operators.model import predict  # noqa: E402
from assayer.plans import jobs  # noqa: E402

HEADLINE = (
    "audit_split", "content_overlap", "lookalike_rows", "params_explode", "input_text",
    "eval_report", "class_weights", "pair_examples", "length_percentiles", "tokens", "doc_freq",
    "tfidf", "batched_scorer", "group_stratified_split",
)


def session(cpus: str) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("assayer-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
        .config("spark.kryoserializer.buffer.max", "512m")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="assayer-bench-"))
        .getOrCreate()
    )


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(job) -> tuple[float, object]:
    start = time.perf_counter()
    result = job()
    return time.perf_counter() - start, result


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    run(QUERIES["split_rows"](spark, sf_dir))  # start the session and the file listing

    seconds: dict[str, float] = {}
    for name in HEADLINE:
        seconds[name], _ = timed(lambda: run(QUERIES[name](spark, sf_dir)))
    seconds["train"], model = timed(lambda: train_model(spark, sf_dir))
    records = views.spread(views.rec(spark, sf_dir))
    seconds["predict"], _ = timed(
        lambda: run(jobs.predict_records(records, lambda t: predict(model, t)))
    )
    rows = records.count()
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in seconds.items()},
                "sf": float(sf.group(1)) if sf else None,
                "records": rows,
                "rows_per_second": {
                    k: round(rows / seconds[k], 1)
                    for k in ("predict", "batched_scorer", "input_text", "audit_split")
                },
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
