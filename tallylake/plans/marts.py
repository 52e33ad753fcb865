"""Business figures: totals per brand, headline KPIs, sample rows.

Each figure has two routes to the same result. From a written flat view it is
a narrow scan. From the sources, the transactions are first summed per card,
so only one row per card and task is shuffled and joined, however many
transactions a card has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylake.functions.presentation import brl, thousands
from tallylake.operators import flat, validity
from tallylake.schema import AMOUNT, Tables
from tallylake.workspace import new_folder

# Fixed values of the published sample.
SAMPLE_ROWS = 8
SAMPLE_COLUMNS = (
    "nome",
    "sobrenome",
    "bandeira_cartao",
    "tipo_conta",
    "vlr_transacao_movimento",
    "data_movimentacao",
)


def card_totals(tables: Tables) -> DataFrame:
    """(id_associado, numero_cartao, bandeira_cartao, qtd, total), one row per card."""
    summed = (
        validity.valid_rows(tables.movements)
        .groupBy("id_cartao")
        .agg(F.count(F.lit(1)).alias("qtd"), F.sum("vlr_transacao").alias("total"))
    )
    return summed.join(
        flat.profile_of(tables), F.col("id_cartao") == F.col("profile_card"), "inner"
    ).select("id_associado", "numero_cartao", "bandeira_cartao", "qtd", "total")


def _brands(rows: DataFrame) -> DataFrame:
    """Amounts are summed as decimals: exact, whatever the order they arrive in."""
    return rows.groupBy("bandeira_cartao").agg(
        F.sum("qtd").alias("qtd_movimentacoes"),
        F.sum("total").cast("double").alias("valor_total"),
    ).orderBy(F.desc("valor_total"), F.asc("bandeira_cartao"))


def brand_mart(tables: Tables) -> DataFrame:
    """Count and total per brand, largest total first."""
    return _brands(card_totals(tables))


def brand_mart_of(flat_view: DataFrame) -> DataFrame:
    """The same from the flat view: a two-column scan, summed in each task."""
    return _brands(
        flat_view.groupBy("bandeira_cartao").agg(
            F.count(F.lit(1)).alias("qtd"),
            F.sum(F.col("vlr_transacao_movimento").cast(AMOUNT)).alias("total"),
        )
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """One row with the number of distinct values, all missing ones being one value more.

    Whole numbers are marked in bitmaps of 32,768 values each, which are combined in each task
    before they move. Others meet in one group per value, where a missing one equals empty text.
    """
    if isinstance(df.schema[column].dataType, T.IntegralType):
        value = F.col(column).cast("bigint")
        marked = df.groupBy(F.bitmap_bucket_number(value).alias("slot")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bits")
        )
        counted = F.when(F.col("slot").isNull(), F.lit(1)).otherwise(F.bitmap_count("bits"))
        return marked.agg(F.coalesce(F.sum(counted), F.lit(0)).alias("n"))
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return df.groupBy(text.alias("value")).agg(F.count(F.lit(1))).agg(F.count(F.lit(1)).alias("n"))


def _kpis(amounts: DataFrame, members: DataFrame) -> DataFrame:
    """KPIs from (numero_cartao, qtd, total) and (id_associado), each with all rows of the view."""
    # a missing value counts as one value, like an empty text would
    per_card = amounts.groupBy(F.coalesce("numero_cartao", F.lit("")).alias("cartao")).agg(
        F.sum("qtd").alias("qtd"), F.sum("total").alias("total")
    )
    figures = per_card.agg(
        F.coalesce(F.sum("qtd"), F.lit(0)).alias("total_registros"),
        F.coalesce(F.sum("total").cast("double"), F.lit(0.0)).alias("valor_total"),
        F.count(F.lit(1)).alias("cartoes_distintos"),
    )
    rows = F.col("total_registros")
    # every row counts in the average, also one without an amount
    average = F.when(rows > 0, F.col("valor_total") / rows).otherwise(F.lit(0.0))
    return figures.select(
        "total_registros",
        "valor_total",
        average.alias("ticket_medio"),
        distinct_values(members, "id_associado").scalar().alias("associados_distintos"),
        "cartoes_distintos",
    )


def kpi_summary(tables: Tables) -> DataFrame:
    """The KPIs straight from the sources; the totals per card are written once and read by both counts."""
    spark = tables.movements.sparkSession
    path = new_folder(spark, "card-totals")
    totals = card_totals(tables)
    totals.write.parquet(path)
    totals = spark.read.schema(totals.schema).parquet(path)
    return _kpis(totals, totals)


def kpi_summary_of(flat_view: DataFrame) -> DataFrame:
    """The same from the flat view: two scans that share no column."""
    amounts = flat_view.groupBy("numero_cartao").agg(
        F.count(F.lit(1)).alias("qtd"),
        F.sum(F.col("vlr_transacao_movimento").cast(AMOUNT)).alias("total"),
    )
    return _kpis(amounts, flat_view)


def kpi_labels(kpis: DataFrame) -> DataFrame:
    """The KPIs as the dashboard shows them."""
    return kpis.select(
        thousands(F.col("total_registros")).alias("total_registros"),
        brl(F.col("valor_total")).alias("valor_total"),
        brl(F.col("ticket_medio")).alias("ticket_medio"),
        thousands(F.col("associados_distintos")).alias("associados_distintos"),
        thousands(F.col("cartoes_distintos")).alias("cartoes_distintos"),
    )


def sample_rows(flat_view: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The latest transactions. Each task keeps only its own best ``rows`` rows."""
    return (
        flat_view.orderBy(
            F.desc(F.col("data_movimentacao").cast("timestamp_ntz")),
            F.asc("numero_cartao"),
            F.asc(F.col("vlr_transacao_movimento").cast(AMOUNT)),
            *[F.asc(c) for c in ("nome", "sobrenome", "bandeira_cartao", "tipo_conta")],
        )
        .limit(rows)
        .select(*SAMPLE_COLUMNS)
    )
