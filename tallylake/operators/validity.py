"""Split transactions by the sign of their amount and count both sides."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylake.functions.presentation import percent

AMOUNT = "vlr_transacao"


class Split(NamedTuple):
    valid: DataFrame
    invalid: DataFrame
    invalid_pct: float


def valid_rows(df: DataFrame, amount: str = AMOUNT) -> DataFrame:
    return df.where(F.col(amount) > 0)


def invalid_rows(df: DataFrame, amount: str = AMOUNT) -> DataFrame:
    return df.where(F.col(amount) <= 0)


def summary(df: DataFrame, amount: str = AMOUNT) -> DataFrame:
    """One row of counts from one pass.

    A NULL amount is neither valid nor invalid but is part of the total.
    """
    value = F.col(amount)
    counts = df.agg(
        F.count(F.lit(1)).alias("total_registros"),
        F.count_if(value > 0).alias("validas"),
        F.count_if(value <= 0).alias("invalidas"),
        F.count_if(value.isNull()).alias("sem_valor"),
    )
    return counts.withColumn(
        "percentual_invalidas", percent(F.col("invalidas"), F.col("total_registros"))
    )


def split(df: DataFrame, amount: str = AMOUNT) -> Split:
    """Both sides, still lazy, and the invalid percentage. Runs one job for the latter."""
    counts = summary(df, amount).first()
    return Split(
        valid_rows(df, amount),
        invalid_rows(df, amount),
        counts["percentual_invalidas"],
    )
