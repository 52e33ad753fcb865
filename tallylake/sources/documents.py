"""Document source: interaction logs with a nested metadata field.

The schema is declared, never inferred: inference reads the collection once
more and cannot name any column of an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallylake.schema import INTERACTION, SPECS


def read_collection(
    spark: SparkSession,
    collection: str = INTERACTION,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Scan a collection through the document connector set up in the session."""
    return (
        spark.read.format("mongodb")
        .option("collection", collection)
        .schema(schema or SPECS[INTERACTION].struct)
        .load()
    )


def read_json_lines(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """Scan the same documents exported as one JSON object per line.

    A line that is no JSON object, or a value of the wrong type, fails the job: as a row of
    NULLs it would be counted as an interaction.
    """
    reader = spark.read.schema(schema or SPECS[INTERACTION].struct)
    return reader.option("mode", "FAILFAST").json(path)
