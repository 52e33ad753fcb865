"""Reading the given tables, cutting lineage with written tables, and running batch functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

import tallylake
from tallylake.workspace import discard, new_folder, shuffles_removed

Batches = Iterator[pa.RecordBatch]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back.

    What follows starts from files that outlive any executor, and is computed once.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_alone(df: DataFrame, label: str) -> DataFrame:
    """``written``, with the shuffle files of the write removed at its end, as the table replaces them."""
    with shuffles_removed(df.sparkSession):
        return written(df, label)


def dropped(*tables: DataFrame) -> None:
    """Remove tables made by ``written``, after the last step that reads them."""
    for table in tables:
        for file in table.inputFiles()[:1]:  # a table is one folder
            discard(table.sparkSession, file.rsplit("/", 1)[0])


def map_batches(
    df: DataFrame, function: Callable[[Batches], Batches], schema: StructType | str
) -> DataFrame:
    """``df.mapInArrow`` with this package on the path of the Python workers.

    The path helps workers that see the same folders as the driver; elsewhere the package
    is installed or sent along with ``--py-files`` as usual.
    """
    root = str(Path(tallylake.__file__).resolve().parent.parent)
    environment = df.sparkSession.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(":")
    if root not in paths:
        environment["PYTHONPATH"] = ":".join([root, *filter(None, paths)])
    return df.mapInArrow(function, schema)
