"""Session settings for running the jobs on a cluster."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

# Connector artifacts; Spark 4 is built for Scala 2.13.
RELATIONAL_PACKAGE = "org.postgresql:postgresql:42.7.3"
DOCUMENT_PACKAGE = "org.mongodb.spark:mongo-spark-connector_2.13:10.5.0"

# AQE picks the join strategy from measured sizes, splits skewed join
# partitions and merges small shuffle partitions up to the advisory size, so
# the initial partition count only has to be high enough.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def settings(
    packages: Sequence[str] = (),
    document_uri: str | None = None,
    shuffle_partitions: int | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """All settings as one dict. Packages go in ONE list: a second one would replace it."""
    conf = dict(ADAPTIVE)
    if packages:
        conf["spark.jars.packages"] = ",".join(packages)
    if document_uri:
        conf["spark.mongodb.read.connection.uri"] = document_uri
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    return conf


def build_session(app_name: str = "tallylake", **options) -> SparkSession:
    """A session with :func:`settings`; master and memory come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in settings(**options).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
