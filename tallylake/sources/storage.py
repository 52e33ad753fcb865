"""Writers. Tables are partitioned folders; a single file is written only on request.

All path handling goes through Hadoop's FileSystem, so the same code works on
HDFS, object stores and local disks.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Quotes inside a value are doubled, as common CSV readers expect, and spaces at
# either end of a value are kept.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

# Keep microseconds; the writers' own default stops at milliseconds.
MOMENT_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

# A CSV file is read by one task (see files.read_csv), so its size is bounded.
CSV_ROWS_PER_FILE = 2_000_000


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _path(spark, path)
    return fs.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path if it is there."""
    fs, target = _path(spark, path)
    fs.delete(target, True)


def require(spark: SparkSession, paths: Iterable[str]) -> None:
    """Raise unless every path exists."""
    missing = [p for p in paths if not exists(spark, p)]
    if missing:
        raise FileNotFoundError(f"missing outputs: {', '.join(missing)}")


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it is missing."""
    fs, target = _path(spark, folder)
    return [status.getPath().getName() for status in fs.listStatus(target)] if fs.exists(target) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small UTF-8 file."""
    fs, target = _path(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_once(spark: SparkSession, text: str, path: str) -> None:
    """Write a small file that must not exist yet; it appears with all of its content."""
    fs, target = _path(spark, path)
    draft = f"{path}.{uuid.uuid4().hex}"
    _, staged = _path(spark, draft)
    stream = fs.create(staged, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if fs.exists(target) or not fs.rename(staged, target):
        fs.delete(staged, False)
        raise FileExistsError(f"{path} was written by another run")


def schema_of(text: str) -> T.StructType:
    """A schema from its JSON form."""
    return T.StructType.fromJson(json.loads(text))


def _write_counted(
    df: DataFrame, path: str, mode: str, counts: Mapping[str, Column] | None, by: Sequence[str] = ()
) -> dict[str, int]:
    seen = Observation()
    if counts:
        df = df.observe(seen, *[value.alias(name) for name, value in counts.items()])
    df.write.mode(mode).partitionBy(*by).parquet(path)
    return {name: seen.get.get(name) or 0 for name in counts} if counts else {}


def write_table(
    df: DataFrame, path: str, counts: Mapping[str, Column] | None = None, mode: str = "overwrite"
) -> dict[str, int]:
    """Replace a Parquet table, keeping whatever partitions the plan ends with; its ``counts``, by name.

    ``counts`` are aggregates of the rows, observed by the very tasks that write them: nothing is read
    again, and a task that is run twice counts once. With the ``mode`` append, rows are added to the table.
    """
    return _write_counted(df, path, mode, counts)


def write_by_month(
    df: DataFrame,
    path: str,
    moment: str,
    month: str = "mes",
    counts: Mapping[str, Column] | None = None,
    mode: str = "overwrite",
) -> dict[str, int]:
    """Replace a Parquet table that is partitioned by calendar month; its ``counts``, as in :func:`write_table`.

    REBALANCE brings the rows of a month together, so a month is a few large
    files instead of one sliver per task, and AQE cuts a month that is far
    bigger than the rest into several tasks.
    """
    dated = df.withColumn(month, F.date_format(moment, "yyyy-MM")).hint("rebalance", month)
    return _write_counted(dated, path, mode, counts, [month])


def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Overwrite only the partitions present in ``df``; others stay as they are."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    """Replace a CSV folder of bounded files, header in each."""
    (
        df.write.mode("overwrite")
        .options(**CSV_OPTIONS, **MOMENT_OPTIONS)
        .option("maxRecordsPerFile", CSV_ROWS_PER_FILE)
        .csv(path)
    )


def write_json(df: DataFrame, path: str) -> None:
    """Replace a folder of JSON lines."""
    df.write.mode("overwrite").options(**MOMENT_OPTIONS).json(path)


def write_csv_ordered(df: DataFrame, path: str, order: Sequence[Column]) -> None:
    """Replace a CSV folder whose files, by name, hold the rows in order.

    Rows are range-partitioned, so any number of them is sorted by many tasks.
    """
    write_csv(df.orderBy(*order), path)


def _single_file(
    df: DataFrame, path: str, order: Sequence[Column], fmt: str, options: dict
) -> None:
    spark = df.sparkSession
    staging = f"{path}.{uuid.uuid4().hex}"
    one = df.repartition(1)
    if order:
        one = one.sortWithinPartitions(*order)
    fs, folder = _path(spark, staging)
    _, target = _path(spark, path)
    try:
        one.write.mode("overwrite").format(fmt).options(**options).save(staging)
        parts = [
            status.getPath()
            for status in fs.listStatus(folder)
            if status.getPath().getName().startswith("part-")
        ]
        if len(parts) != 1:
            raise RuntimeError(f"expected one part file in {staging}, found {len(parts)}")
        fs.delete(target, True)
        if not fs.rename(parts[0], target):
            raise RuntimeError(f"could not move the export to {path}")
    finally:
        fs.delete(folder, True)


def export_csv(df: DataFrame, path: str, order: Sequence[Column] = ()) -> None:
    """One CSV file, for a caller who needs one: all rows pass through one task."""
    _single_file(df, path, order, "csv", CSV_OPTIONS | MOMENT_OPTIONS)


def export_parquet(df: DataFrame, path: str, order: Sequence[Column] = ()) -> None:
    """One Parquet file, for a caller who needs one: all rows pass through one task."""
    _single_file(df, path, order, "parquet", {})


def write_document(spark: SparkSession, document: dict, path: str) -> None:
    """Write one JSON document, UTF-8, indented."""
    fs, target = _path(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(json.dumps(document, ensure_ascii=False, indent=2), "utf-8"))
    finally:
        stream.close()
