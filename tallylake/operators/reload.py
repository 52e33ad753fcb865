"""Copies and repeated loads: keep one row per key without a window.

A window would sort all copies of a key in one task. Grouping keeps a single
candidate per key and task before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _one_per_key(df: DataFrame, key: Sequence[str], rest: Sequence[str], pick) -> DataFrame:
    if not rest:
        return df.select(*key).distinct().select(*df.columns)
    if len(rest) == 1:
        kept = df.groupBy(*key).agg(pick(F.col(rest[0])).alias(rest[0]))
    else:
        kept = df.groupBy(*key).agg(pick(F.struct(*rest)).alias("kept")).select(*key, "kept.*")
    return kept.select(*df.columns)


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str] = ("id",)) -> DataFrame:
    """One row per key: the smallest in ``order``, then in the remaining columns.

    NULLs in the key compare equal, and the row kept is the same on every run.
    """
    rest = list(order) + [c for c in df.columns if c not in key and c not in order]
    return _one_per_key(df, list(key), rest, F.min)


def latest_per_key(df: DataFrame, key: Sequence[str], version: Sequence[str]) -> DataFrame:
    """One row per key: the greatest in ``version``, then in the remaining columns."""
    rest = list(version) + [c for c in df.columns if c not in key and c not in version]
    return _one_per_key(df, list(key), rest, F.max)


def _same(keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(f"t.{k}").eqNullSafe(F.col(f"b.{k}"))
    return condition


def upsert(
    target: DataFrame, batch: DataFrame, key: Sequence[str], version: Sequence[str]
) -> DataFrame:
    """Load ``batch`` into ``target``: per key the latest version over both is kept.

    A batch row replaces a target row of the same version. Loading the same batch again, or an
    older one late, changes nothing. One aggregate by key; rows of a key are combined in
    each task before they move.
    """
    rest = [c for c in target.columns if c not in key and c not in version]
    both = target.withColumn("loaded", F.lit(0)).unionByName(batch.withColumn("loaded", F.lit(1)))
    newest = F.max(F.struct(*version, "loaded", *rest)).alias("kept")
    return both.groupBy(*key).agg(newest).select(*key, "kept.*").select(*target.columns)


def insert_new(target: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """Append only the batch rows whose key the target does not hold yet."""
    order = [c for c in batch.columns if c not in key]
    fresh = first_per_key(batch, key, order).alias("t").join(
        target.select(*key).distinct().alias("b"), _same(key), "left_anti"
    )
    return target.unionByName(fresh)
