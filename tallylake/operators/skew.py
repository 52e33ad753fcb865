"""Joins that stay balanced when a few keys hold much of the left side.

AQE cuts a skewed join partition only when both join inputs come straight from
a shuffle. Where the right input is itself the result of a join on the same
key there is no such shuffle, so the heavy keys are spread here instead.

A key is heavy when it holds more rows than an average shuffle partition, so
there are never more heavy keys than shuffle partitions: that bounds the
broadcast list of heavy keys and the number of extra right-side copies at any
data size. Every other key joins as usual, and no row is dropped or sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _partition_rows(df: DataFrame, rows: Column, partitions: int | None) -> Column:
    """Rows of an average shuffle partition; ``rows`` is their total as an aggregate of ``df``."""
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return F.greatest(F.ceil(df.agg(rows).scalar() / F.lit(partitions)), F.lit(1))


def heavy_keys(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """(heavy_key, pieces): at most ``partitions`` rows; a key is cut into ``pieces``."""
    groups = (
        df.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("heavy_key"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # the total comes from the groups, whose shuffle Spark then uses twice
    pieces = F.ceil(F.col("n") / _partition_rows(groups, F.sum("n"), partitions)).cast("int")
    return groups.select("heavy_key", pieces.alias("pieces")).where(F.col("pieces") > 1)


def balanced_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    spread: Column,
    how: str = "inner",
    partitions: int | None = None,
) -> DataFrame:
    """Inner or left join of ``left`` and ``right``; all columns of both.

    ``spread`` is a column of the left row (its id, say) that decides which
    piece of a heavy key the row goes to. It must not be random: a task that
    is run again has to send its rows to the same pieces.
    """
    heavy = F.broadcast(heavy_keys(left, left_key, partitions))

    cut_left = left.join(heavy, F.col(left_key) == F.col("heavy_key"), "left").withColumn(
        "left_piece",
        F.when(F.col("pieces").isNull(), F.lit(0)).otherwise(
            F.pmod(F.xxhash64(spread), F.col("pieces")).cast("int")
        ),
    )
    cut_right = right.join(heavy, F.col(right_key) == F.col("heavy_key"), "left").withColumn(
        "right_piece",
        F.explode(F.sequence(F.lit(0), F.coalesce(F.col("pieces"), F.lit(1)) - 1)),
    )
    return (
        cut_left.drop("heavy_key", "pieces")
        .join(
            cut_right.drop("heavy_key", "pieces"),
            (F.col(left_key) == F.col(right_key))
            & (F.col("left_piece") == F.col("right_piece")),
            how,
        )
        .drop("left_piece", "right_piece")
    )


def rows_with_key_in(
    df: DataFrame,
    key: str,
    wanted: DataFrame,
    partitions: int | None = None,
) -> DataFrame:
    """Rows of ``df`` whose key is listed in ``wanted`` (key, n), n being its rows in ``df``.

    Rows of heavy keys are picked out where they are, against a broadcast list
    of at most ``partitions`` keys; the others meet their key by a shuffle.
    """
    limit = _partition_rows(df, F.count(F.lit(1)), partitions)
    heavy = F.broadcast(wanted.where(F.col("n") > limit).select(F.col("key").alias("wanted_key")))
    light = wanted.where(F.col("n") <= limit).select(F.col("key").alias("wanted_key"))
    matches = F.col(key) == F.col("wanted_key")
    return df.join(heavy, matches, "left_semi").unionByName(
        df.join(heavy, matches, "left_anti").join(light, matches, "left_semi")
    )
