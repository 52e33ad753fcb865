"""Tables cut into buckets by a key when they are written, so that joins on it need not move them.

A key that holds more rows than an average bucket would make its bucket, and the task that joins it,
as large as itself. The rows of such heavy keys are kept apart, cut by size as any table, and their
number of keys is bounded by the number of buckets.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.operators.skew import heavy_keys
from tallylake.sources import storage


@dataclass(frozen=True)
class Bucketed:
    """A written table: rows of light keys in buckets, rows of heavy keys apart, and the heavy keys."""

    by: str
    light: DataFrame
    heavy: DataFrame
    heavy_keys: DataFrame

    @property
    def rows(self) -> DataFrame:
        return self.light.unionByName(self.heavy)


def write(df: DataFrame, path: str, by: str, buckets: int) -> None:
    """Replace the table at ``path``; rows without a key are with the light ones."""
    spark = df.sparkSession
    heavy = heavy_keys(df, by, buckets).select("heavy_key")
    storage.write_table(heavy, f"{path}/heavy_keys")
    listed = F.broadcast(spark.read.schema(heavy.schema).parquet(f"{path}/heavy_keys"))
    storage.write_table(df.join(listed, F.col(by) == F.col("heavy_key"), "left_semi"), f"{path}/heavy")
    # one file a bucket: the shuffle deals rows as the buckets do
    light = df.join(listed, F.col(by) == F.col("heavy_key"), "left_anti").repartition(buckets, by)
    storage.remove(spark, f"{path}/meta.json")
    name = _name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    light.write.mode("overwrite").bucketBy(buckets, by).sortBy(by).option("path", f"{path}/light").saveAsTable(name)
    meta = {"schema": df.schema.json(), "key_type": heavy.schema.json(), "by": by, "buckets": buckets}
    storage.write_once(spark, json.dumps(meta), f"{path}/meta.json")


def _name(path: str) -> str:
    return "bucketed_" + hashlib.sha256(path.encode()).hexdigest()[:32]


def read(spark: SparkSession, path: str) -> Bucketed:
    """The table at ``path``, also one that another session has written."""
    meta = json.loads(storage.read_text(spark, f"{path}/meta.json"))
    schema, by = storage.schema_of(meta["schema"]), meta["by"]
    name = _name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{by}`) SORTED BY (`{by}`) "
            f"INTO {meta['buckets']} BUCKETS LOCATION '{path}/light'"
        )
    keys = spark.read.schema(storage.schema_of(meta["key_type"])).parquet(f"{path}/heavy_keys")
    return Bucketed(by, spark.table(name), spark.read.schema(schema).parquet(f"{path}/heavy"), keys)
