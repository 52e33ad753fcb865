"""Rows joined with facts about their key where one key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread_over(df: DataFrame, by: Column) -> Column:
    """A number below the session's shuffle partitions, the same for a row whenever it is asked."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return F.pmod(F.xxhash64(by), F.lit(partitions)).cast("int")


def join_facts(rows: DataFrame, facts: DataFrame, key: str, spread: Column) -> DataFrame:
    """``rows`` left join ``facts``, which has one row per ``key``; NULL keys meet nothing.

    The rows of a key are dealt by ``spread`` (a column of ``rows``, its id say) over as many pieces
    as there are shuffle partitions. The pieces that occur, at most that many per key, get the
    facts first, and then every piece of a key is a join key of its own.
    """
    piece = spread_over(rows, spread)
    cut = rows.withColumn("piece", piece)
    pieces = cut.filter(F.col(key).isNotNull()).select(key, "piece").distinct()
    return cut.join(pieces.join(facts, key), [key, "piece"], "left").drop("piece")
