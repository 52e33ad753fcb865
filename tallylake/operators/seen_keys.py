"""Copies dropped load by load, without reading what was loaded before.

An index holds every key that was let through, cut into buckets by the key's hash. A load is first
reduced to one row per key; a bitmap of its keys' hashes, of a fixed size, then thins the index
where it is read, so that of the old keys only those that may be in the load are shuffled to it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.operators import reload
from tallylake.operators.keyed_table import BUCKET, bucket_of
from tallylake.sources import storage
from tallylake.workspace import discard, new_folder

SLOTS = 4_096  # pieces of 32,768 bits, 4 KB each: the bitmap never has more than 16 MB


def _hash(key: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(F.lit("seen"), *[F.col(k).isNull() for k in key], *key), F.lit(SLOTS * 32_768))


def bitmap(keys: DataFrame, key: Sequence[str]) -> DataFrame:
    """(slot, bits): which hashes the keys have; at most ``SLOTS`` rows whatever their number."""
    marked = keys.select((_hash(key) + 1).alias("h"))  # positions count from 1
    return marked.groupBy(F.bitmap_bucket_number("h").alias("slot")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("bits")
    )


def maybe_in(df: DataFrame, bits: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key may be one of those of the bitmap; no row of such a key is lost."""
    h = _hash(key) + 1
    placed = df.withColumns({"slot": F.bitmap_bucket_number(h), "at": F.bitmap_bit_position(h)})
    byte = F.conv(F.hex(F.substring("bits", (F.col("at") / 8).cast("int") + 1, F.lit(1))), 16, 10)
    hit = F.getbit(byte.cast("bigint"), (F.col("at") % 8).cast("int")) == 1
    found = placed.join(F.broadcast(bits), "slot").where(hit)
    return found.drop("slot", "at", "bits")


def _index(spark: SparkSession, path: str, like: DataFrame, key: Sequence[str]) -> DataFrame:
    schema = like.select(*key).schema.add(BUCKET, "integer").add("carga", "string")
    return spark.read.schema(schema).parquet(path)


def load(
    batch: DataFrame,
    load_id: str,
    index: str,
    target: str,
    key: Sequence[str],
    order: Sequence[str] = ("id",),
    buckets: int = 64,
) -> None:
    """Append the rows of ``batch`` whose key no other load has had, one per key, to ``target``.

    Within a load the smallest row in ``order`` stays, and an earlier load wins over a later one, so
    loads that come in that order leave the rows of :func:`reload.first_per_key` over all of
    them. A repeated load replaces its own rows and keys; loads after it keep theirs.
    """
    spark = batch.sparkSession
    staged = new_folder(spark, "seen")
    try:
        first = reload.first_per_key(batch, key, order)
        bucketed = first.withColumn(BUCKET, bucket_of(key, buckets))
        bucketed.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(staged)
        fresh = spark.read.schema(first.schema.add(BUCKET, "integer")).parquet(staged)
        if storage.exists(spark, index):
            touched = [
                int(name.split("=")[1])
                for name in storage.names(spark, staged)
                if name.startswith(f"{BUCKET}=")
            ]
            old = _index(spark, index, first, key).where(
                F.col(BUCKET).isin(touched) & (F.col("carga") != load_id)
            )
            old = maybe_in(old, bitmap(fresh, key), key).select(BUCKET, *key).alias("t")
            same = F.col(f"b.{BUCKET}") == F.col(f"t.{BUCKET}")
            for k in key:
                same = same & F.col(f"b.{k}").eqNullSafe(F.col(f"t.{k}"))
            fresh = fresh.alias("b").join(old, same, "left_anti")
        marked = fresh.withColumn("carga", F.lit(load_id))
        kept = new_folder(spark, "fresh")
        try:
            marked.write.parquet(kept)
            rows = spark.read.schema(marked.schema).parquet(kept)
            # rows first: a load cut short before its keys are in the index is loaded again as a whole
            _replace(rows.drop(BUCKET), target, ["carga"], load_id)
            _replace(rows.select(*key, "carga", BUCKET), index, ["carga", BUCKET], load_id)
        finally:
            discard(spark, kept)
    finally:
        discard(spark, staged)


def _replace(rows: DataFrame, path: str, by: Sequence[str], load_id: str) -> None:
    storage.remove(rows.sparkSession, f"{path}/carga={load_id}")
    rows.write.mode("append").partitionBy(*by).parquet(path)


def read(spark: SparkSession, target: str) -> DataFrame:
    """All rows let through so far."""
    return spark.read.parquet(target).drop("carga")
