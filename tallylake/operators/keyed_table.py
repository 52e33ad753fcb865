"""Tables on disk with one row per key, cut into buckets by the key's hash.

A load touches only the buckets its keys fall into: those are read, merged and rewritten, the files of
all others stay as they are. Within a bucket no row of the table is sorted against its own kind
again, since its keys are unique already: the load, reduced to one row per key, is joined to it.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.operators import reload
from tallylake.sources import storage
from tallylake.workspace import discard, new_folder

BUCKET = "balde"
_META = "_buckets.json"  # readers of the table skip names that begin with an underscore


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    """The bucket of a key, NULLs included. Equal values of different types may differ in it."""
    # a NULL leaves the hash of what precedes it unchanged, so NULLs are told apart by flags
    flags = [F.col(k).isNull() for k in key]
    return F.pmod(F.xxhash64(*flags, *key), F.lit(buckets)).cast("int")


def _write(df: DataFrame, path: str) -> None:
    spread = df.hint("rebalance", BUCKET)
    storage.replace_partitions(spread, path, [BUCKET])


def create(df: DataFrame, path: str, key: Sequence[str], version: Sequence[str], buckets: int) -> None:
    """Write a new table: the latest version of every key of ``df``. Some 1 GB a bucket is a good size."""
    spark = df.sparkSession
    kept = reload.latest_per_key(df, key, version)
    _write(kept.withColumn(BUCKET, bucket_of(key, buckets)), path)
    meta = {"key": list(key), "version": list(version), "buckets": buckets, "schema": df.schema.json()}
    storage.write_once(spark, json.dumps(meta), f"{path}/{_META}")


def _meta(spark: SparkSession, path: str) -> dict:
    return json.loads(storage.read_text(spark, f"{path}/{_META}"))


def _stored(spark: SparkSession, path: str, meta: dict) -> DataFrame:
    schema = storage.schema_of(meta["schema"])
    return spark.read.schema(schema.add(BUCKET, "integer")).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return _stored(spark, path, _meta(spark, path)).drop(BUCKET)


def _buckets_in(spark: SparkSession, path: str) -> list[int]:
    """Buckets that a written table has rows in, from its folders."""
    prefix = f"{BUCKET}="
    return [int(n.removeprefix(prefix)) for n in storage.names(spark, path) if n.startswith(prefix)]


def merge(spark: SparkSession, path: str, batch: DataFrame) -> list[int]:
    """Load ``batch``: per key the latest version stays; the buckets that were rewritten.

    A batch row replaces a stored row of the same version. NULL keys compare equal. Loading the same batch
    again, or an older one late, changes nothing, so a load that was cut short between two
    buckets is simply loaded again.
    """
    meta = _meta(spark, path)
    key, version = meta["key"], meta["version"]
    schema = storage.schema_of(meta["schema"])
    typed = batch.select(*[F.col(f.name).cast(f.dataType) for f in schema])
    staged = new_folder(spark, "merge")
    try:
        newest = reload.latest_per_key(typed, key, version)
        _write(newest.withColumn(BUCKET, bucket_of(key, meta["buckets"])), staged)
        touched = _buckets_in(spark, staged)
        if not touched:
            return []
        incoming = _stored(spark, staged, meta)
        held = _stored(spark, path, meta).where(F.col(BUCKET).isin(touched))
        _write(_newer(held, incoming, key, version), path)
        return sorted(touched)
    finally:
        discard(spark, staged)


def _newer(held: DataFrame, incoming: DataFrame, key: Sequence[str], version: Sequence[str]) -> DataFrame:
    """Of two tables with one row per key, the later row of each key."""

    def whole(df: DataFrame, name: str) -> DataFrame:
        rest = [c for c in df.columns if c not in (*key, BUCKET)]
        return df.select(
            *[F.col(k).alias(f"{name}_{k}") for k in (BUCKET, *key)],
            F.struct(*[F.col(c) for c in version], F.lit(0)).alias(f"{name}_version"),
            F.struct(F.lit(0).alias("_"), *rest).alias(f"{name}_rest"),
        )

    same = reduce(
        Column.__and__,
        [F.col(f"old_{k}").eqNullSafe(F.col(f"new_{k}")) for k in (BUCKET, *key)],
    )
    both = whole(held, "old").join(whole(incoming, "new"), same, "full_outer")
    take_new = F.col("old_rest").isNull() | (
        F.col("new_rest").isNotNull() & (F.col("new_version") >= F.col("old_version"))
    )
    picked = both.select(
        F.when(take_new, F.struct(*[F.col(f"new_{k}").alias(k) for k in (BUCKET, *key)]))
        .otherwise(F.struct(*[F.col(f"old_{k}").alias(k) for k in (BUCKET, *key)]))
        .alias("k"),
        F.when(take_new, F.col("new_rest")).otherwise(F.col("old_rest")).alias("rest"),
    )
    return picked.select("k.*", "rest.*").select(*held.columns)
