"""Star to snowflake: the brand and the calendar day become dimensions of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylake.operators import star, validity
from tallylake.schema import Tables


def brand_key(brand: Column) -> Column:
    """Key derived from the name, so it is the same in every run and needs no numbering."""
    return F.md5(brand)


def day_key(moment: Column) -> Column:
    """2024-05-01 12:00 -> 20240501."""
    return F.year(moment) * 10000 + F.month(moment) * 100 + F.day(moment)


def dim_brand(cards: DataFrame) -> DataFrame:
    names = cards.where(F.col("bandeira").isNotNull()).select("bandeira").distinct()
    return names.select(brand_key(F.col("bandeira")).alias("id_bandeira"), "bandeira")


def dim_time(movements: DataFrame, moment: str = "data_movimentacao") -> DataFrame:
    """Every day from the first to the last transaction, days without any included."""
    span = movements.agg(
        F.min(moment).cast("date").alias("first"), F.max(moment).cast("date").alias("last")
    ).where(F.col("first").isNotNull())
    day = F.col("data")
    return span.select(
        F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("data")
    ).select(
        day_key(day).alias("id_data"),
        "data",
        F.year(day).alias("ano"),
        F.quarter(day).alias("trimestre"),
        F.month(day).alias("mes"),
        F.day(day).alias("dia"),
        (F.weekday(day) + 1).alias("dia_semana"),
    )


def build(tables: Tables) -> dict[str, DataFrame]:
    """The star's tables with brand and day moved into their own dimensions.

    The fact takes the brand's key along in its one card lookup. Days are taken from the valid
    transactions themselves, before any join.
    """
    tables_of_star = star.build(tables)
    valid = validity.valid_rows(tables.movements)
    brand = brand_key(F.col("bandeira")).alias("id_bandeira")
    fact = star.fact_movement(valid, tables.cards, brand)
    return tables_of_star | {
        "dim_bandeira": dim_brand(tables.cards),
        "dim_tempo": dim_time(valid),
        "dim_cartao": tables_of_star["dim_cartao"].withColumn("id_bandeira", brand).drop("bandeira"),
        "fato_movimentacao": fact.withColumn("id_data", day_key(F.col("data_movimentacao"))),
    }
