"""Readers for lake files: source snapshots and the published outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylake import schema as S
from tallylake.sources import storage

# The published names and types of the report.
REPORT_SCHEMA = T.StructType(
    [
        T.StructField("movimentacoes_invalidas_descartadas_pct", T.DoubleType()),
        T.StructField(
            "metricas_movimentacao_bruta",
            T.StructType(
                [
                    T.StructField("total_registros", T.LongType()),
                    T.StructField(
                        "percentual_nulos_por_coluna", T.MapType(T.StringType(), T.DoubleType())
                    ),
                    T.StructField("percentual_duplicados", T.DoubleType()),
                    T.StructField("total_duplicados", T.LongType()),
                ]
            ),
        ),
    ]
)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header row. Without a schema every column is text.

    Values may hold line breaks, so a file is never cut between two tasks; the
    writers here produce many bounded files, which is what spreads the work.
    """
    # An empty field is NULL and a quoted empty one is empty text; with the default
    # null marker, which is empty too, both would be NULL.
    reader = spark.read.options(
        **storage.CSV_OPTIONS, multiLine="true", nullValue="\u0000"
    )
    return reader.schema(schema).csv(path) if schema else reader.csv(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """The quality report as one row; absent figures become zero, an absent map empty.

    A document that is cut off or has a figure of the wrong type fails the job, and so does a
    folder with no report or several: such a run must not look like a perfect one.
    """
    raw = spark.read.schema(REPORT_SCHEMA).options(multiLine="true", mode="FAILFAST").json(path)
    names = raw.columns
    one = raw.agg(F.count(F.lit(1)).alias("n"), F.first(F.struct(*names)).alias("report"))
    checked = F.when(F.col("n") == 1, F.col("report")).otherwise(
        F.raise_error(F.format_string("expected one quality report, found %d", F.col("n")))
    )
    raw = one.select(checked.alias("report")).select("report.*")
    body = F.col("metricas_movimentacao_bruta")
    empty_map = F.create_map().cast("map<string,double>")
    return raw.select(
        F.coalesce("movimentacoes_invalidas_descartadas_pct", F.lit(0.0)).alias(
            "movimentacoes_invalidas_descartadas_pct"
        ),
        F.coalesce(body["total_registros"], F.lit(0)).alias("total_registros"),
        F.coalesce(body["percentual_duplicados"], F.lit(0.0)).alias("percentual_duplicados"),
        F.coalesce(body["total_duplicados"], F.lit(0)).alias("total_duplicados"),
        F.coalesce(body["percentual_nulos_por_coluna"], empty_map).alias(
            "percentual_nulos_por_coluna"
        ),
    )


def read_snapshot(spark: SparkSession, folder: str) -> S.Tables:
    """The five tables from a folder written by :func:`land`."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}")

    return S.Tables(
        members=table(S.MEMBER),
        accounts=table(S.ACCOUNT),
        cards=table(S.CARD),
        movements=table(S.MOVEMENT),
        interactions=table(S.INTERACTION),
    )


def land(tables: S.Tables, folder: str) -> S.Tables:
    """Copy live sources into Parquet once and work from the copy.

    A run reads the transactions several times; without the copy each of those
    scans would hit the live database and could see different rows.
    """
    spark = tables.movements.sparkSession
    for name, df in tables.by_name().items():
        storage.write_table(df, f"{folder}/{name}")
    return read_snapshot(spark, folder)
