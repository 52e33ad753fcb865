"""Quality figures over time: one partition per run, replaced when a run is repeated.

Beside the figures go the states they come from, one partition per load: the rows of each business
key of that load. The report of all loads is made of the states alone, so a new day is the only part of the
table that is read, and copies of a key in different loads are still found.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.operators import profile
from tallylake.operators.validity import AMOUNT
from tallylake.sources import storage

SCHEMA = "metrica string, coluna string, valor double, run_id string"

FIGURES = (
    "total_registros",
    "movimentacoes_invalidas_descartadas_pct",
    "total_duplicados",
    "percentual_duplicados",
)


def metrics(report: DataFrame) -> DataFrame:
    """(metrica, coluna, valor): every figure of a report row as a row of its own."""

    def line(metric, column, value):
        return F.struct(
            metric.alias("metrica"),
            column.cast("string").alias("coluna"),
            value.cast("double").alias("valor"),
        )

    figures = F.array(*[line(F.lit(name), F.lit(None), F.col(name)) for name in FIGURES])
    shares = F.transform(
        F.map_entries("percentual_nulos_por_coluna"),
        lambda e: line(F.lit("percentual_nulos"), e["key"], e["value"]),
    )
    return report.select(F.inline(F.concat(figures, shares)))


def record(report: DataFrame, run_id: str, path: str) -> None:
    """Write one run; only that run's partition is touched."""
    rows = metrics(report).withColumn("run_id", F.lit(run_id))
    storage.replace_partitions(rows, path, ["run_id"])


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def record_load(
    load: DataFrame, load_id: str, path: str, key: Sequence[str], amount: str | None = AMOUNT
) -> None:
    """Keep the state of one load, in one pass over it; a repeated load replaces its own state."""
    groups = profile.key_groups(load, key, amount)
    storage.replace_partitions(groups.withColumn("carga", F.lit(load_id)), path, ["carga"])


def profile_of_loads(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    key: Sequence[str],
    amount: str | None = AMOUNT,
) -> profile.Profile:
    """The profile of all loads kept at ``path``, as if measured on their rows at once.

    ``columns`` are those of the loads, in order. Only the states are read.
    """
    stored = spark.read.parquet(path)
    return profile.of_groups(
        profile.merged_groups(stored, columns, key, amount), columns, key, amount
    )
