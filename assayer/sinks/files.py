"""Writers. Each writes a directory of part files."""

from __future__ import annotations

import shutil
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCORED_COLUMNS = (
    "record_id", "server_slug", "name", "description",
    "true_category", "predicted_category", "correct",
)


def _csv_field(name: str) -> Column:
    """RFC 4180: quoted only when needed, inner quotes doubled."""
    value = F.coalesce(F.col(name), F.lit(""))
    quoted = F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(value.rlike(r'[,"\r\n]'), quoted).otherwise(value)


HEADER = "record_id,category"


def write_predictions_csv(
    scored: DataFrame, path: str, order_col: str | None = None, single_file: bool = False
) -> None:
    """``record_id,category`` with CRLF line ends and the header in every part file.

    ``single_file`` gives one part file with one header; see :func:`joined_parts`.

    With ``order_col`` the part files are range-partitioned, so reading them in name
    order gives input order; without it there is no shuffle. The lines go through the text
    writer because the CSV writer turns a newline inside a value into the line end.
    """
    line = F.concat_ws(",", _csv_field("record_id"), _csv_field("category")).alias("value")
    if single_file:
        head = scored.sparkSession.range(0, 1, 1, 1).select(F.lit(HEADER).alias("value"))
        if order_col:
            head = head.withColumns({"_at": F.lit(None).cast(scored.schema[order_col].dataType), "_head": F.lit(0)})
            rows = scored.select(line, F.col(order_col).alias("_at"), F.lit(1).alias("_head"))
            # The header sorts before all rows, so the first part holds it.
            lines = head.unionByName(rows).orderBy("_head", "_at").select("value")
        else:
            lines = head.unionByName(scored.select(line))
        parts = f"{path}/_parts"
        lines.write.mode("overwrite").option("lineSep", "\r\n").text(parts)
        joined_parts(scored.sparkSession, parts, path, "part-00000.txt")
        return
    rows = scored.orderBy(order_col) if order_col else scored
    # The low 33 bits of this id count the rows of one task, that is of one part file.
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    text = F.when(first, F.concat(F.lit(HEADER + "\r\n"), line)).otherwise(line)
    rows.select(text.alias("value")).write.mode("overwrite").option("lineSep", "\r\n").text(path)


def joined_parts(spark: SparkSession, parts: str, folder: str, name: str) -> None:
    """One file ``folder/name`` from the part files under ``parts``, in the order of their names.

    Lengths are known, so every part has its place. Where the file system can concatenate, no byte moves.
    On a file system that workers see as folders, tasks copy the parts to their places side by side; a
    repeated task writes the same bytes again. Elsewhere the driver's JVM copies them in a stream.
    The file gets its name, and the folder its ``_SUCCESS``, once it is whole; other files of the
    folder, and ``parts``, go.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop
    top = hadoop.fs.Path(folder)
    system = top.getFileSystem(conf)
    source = system.makeQualified(hadoop.fs.Path(parts))
    found = sorted((s.getPath().getName(), s.getLen()) for s in system.listStatus(source))
    # The names of one job's parts sort by their number.
    listed = [(n, size) for n, size in found if n.startswith("part-")]
    target = hadoop.fs.Path(source, "_joined")
    starts, at = [], 0
    for part, size in listed:
        starts.append((part, at, size))
        at += size
    if system.getUri().getScheme() == "file":
        _copy_side_by_side(spark, source.toUri().getPath(), starts, at)
    else:
        paths = [hadoop.fs.Path(source, part) for part, _, size in starts if size]
        try:
            array = spark.sparkContext._gateway.new_array(hadoop.fs.Path, len(paths) - 1)
            for i, each in enumerate(paths[1:]):
                array[i] = each
            if len(paths) > 1:
                system.concat(paths[0], array)
            system.rename(paths[0], target)
        except Exception as refused:  # the gateway wraps the file system's refusal
            if "UnsupportedOperation" not in str(refused):
                raise
            stream = system.create(target, True)
            for each in paths:
                part = system.open(each)
                hadoop.io.IOUtils.copyBytes(part, stream, 1 << 20, False)
                part.close()
            stream.close()
    for status in system.listStatus(top):
        if status.getPath().getName() != source.getName():
            system.delete(status.getPath(), True)
    system.rename(target, hadoop.fs.Path(top, name))
    system.delete(source, True)
    system.create(hadoop.fs.Path(top, "_SUCCESS"), True).close()


def _copy_side_by_side(spark: SparkSession, folder: str, starts: list[tuple[str, int, int]], size: int) -> None:
    with open(f"{folder}/_joined", "wb") as whole:
        whole.truncate(size)

    # Nested, so that it is shipped by value and workers need not have this package.
    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open(f"{folder}/{row['part']}", "rb") as part, open(f"{folder}/_joined", "r+b") as whole:
                    whole.seek(row["at"])
                    shutil.copyfileobj(part, whole, 1 << 20)
            yield batch

    jobs = spark.createDataFrame(starts, "part string, at bigint, size bigint")
    tasks = max(1, min(len(starts), 10_000))
    copied = jobs.repartition(tasks, "part").mapInArrow(copy, jobs.schema).agg(F.sum("size").alias("n")).first()["n"]
    if (copied or 0) != size:
        raise OSError(f"{copied} of {size} bytes were joined under {folder}")


def write_scored_jsonl(scored: DataFrame, path: str) -> None:
    scored.select(*SCORED_COLUMNS).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_report_json(report: DataFrame, path: str) -> None:
    """A report of a few nested rows (metrics, audit summary or grouped examples)."""
    report.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def artifact_size_mb(spark: SparkSession, path: str) -> DataFrame:
    """Bytes under a folder / 1024^2, two decimals. File contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    size = F.coalesce(F.sum("length"), F.lit(0)) / F.lit(1024.0 * 1024.0)
    return files.agg(F.round(size, 2).alias("size_mb"))
