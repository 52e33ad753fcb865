"""Tables behind the two dashboards. Drawing them is left to the front end.

The quality tables start from one report row, whether it comes straight from
``Profile.report()`` or from the published JSON document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylake.functions.presentation import bar_width, severity_colour, severity_label
from tallylake.operators.profile import ranking


def with_severity(df: DataFrame, share: str) -> DataFrame:
    return df.withColumns(
        {"severidade": severity_label(F.col(share)), "cor": severity_colour(F.col(share))}
    )


def null_shares(report: DataFrame) -> DataFrame:
    """(posicao, coluna, percentual_nulos) from the report's map."""
    return report.select(
        F.posexplode("percentual_nulos_por_coluna").alias("posicao", "coluna", "percentual_nulos")
    )


def null_ranking(report: DataFrame) -> DataFrame:
    """Columns from most to fewest nulls, with severity."""
    return ranking(with_severity(null_shares(report), "percentual_nulos"))


def _worst() -> Column:
    """Struct of the first column, in table order, with the largest share of nulls."""
    entries = F.map_entries("percentual_nulos_por_coluna")
    ranked = F.transform(
        entries,
        lambda e, i: F.struct(
            e["value"].alias("share"), (-i).alias("rank"), e["key"].alias("name")
        ),
    )
    return F.array_max(ranked)


def _worst_share() -> Column:
    return F.coalesce(_worst()["share"], F.lit(0.0))


def quality_headline(report: DataFrame) -> DataFrame:
    """One row: the figures at the top of the quality dashboard."""
    invalid = F.col("movimentacoes_invalidas_descartadas_pct")
    copies = F.col("percentual_duplicados")
    return report.select(
        "total_registros",
        invalid.alias("percentual_invalidas"),
        severity_label(invalid).alias("severidade_invalidas"),
        severity_colour(invalid).alias("cor_invalidas"),
        "total_duplicados",
        "percentual_duplicados",
        severity_label(copies).alias("severidade_duplicados"),
        severity_colour(copies).alias("cor_duplicados"),
        F.coalesce(_worst()["name"], F.lit("—")).alias("pior_coluna"),
        _worst_share().alias("percentual_pior_coluna"),
    )


def quality_bars(report: DataFrame) -> DataFrame:
    """(indicador, percentual, largura) for the three bars of the main dashboard."""
    bars = {
        "movimentacoes_invalidas": F.col("movimentacoes_invalidas_descartadas_pct"),
        "registros_duplicados": F.col("percentual_duplicados"),
        "maior_percentual_nulos": _worst_share(),
    }
    lines = [
        F.struct(
            F.lit(name).alias("indicador"),
            share.alias("percentual"),
            bar_width(share).alias("largura"),
        )
        for name, share in bars.items()
    ]
    return report.select(F.inline(F.array(*lines)))


def _point(chart: str, position, label, value, count, colour) -> list[Column]:
    return [
        F.lit(chart).alias("grafico"),
        position.cast("int").alias("posicao"),
        label.alias("rotulo"),
        value.cast("decimal(38,2)").alias("valor"),
        count.cast("bigint").alias("quantidade"),
        colour.cast("string").alias("cor"),
    ]


def brand_points(mart: DataFrame) -> DataFrame:
    """A row per brand. The chart's order is by value, largest first, then by label."""
    none = F.lit(None)
    return mart.select(
        *_point(
            "bandeiras", none, F.col("bandeira_cartao"), F.col("valor_total"),
            F.col("qtd_movimentacoes"), none,
        )
    )


def null_points(report: DataFrame) -> DataFrame:
    """A row per column. The chart's order is by value, largest first, then by position."""
    shares = with_severity(null_shares(report), "percentual_nulos")
    return shares.select(
        *_point(
            "nulos", F.col("posicao"), F.col("coluna"), F.col("percentual_nulos"),
            F.lit(None), F.col("cor"),
        )
    )


def chart_points(mart: DataFrame, report: DataFrame) -> DataFrame:
    """(grafico, posicao, rotulo, valor, quantidade, cor): the points of both charts."""
    return brand_points(mart).unionByName(null_points(report))


def null_series(report: DataFrame) -> DataFrame:
    """JSON arrays of column names, null percentages and colours, worst first.

    They are as long as the profiled table has columns, all from the report's one row.
    """
    entries = F.transform(
        F.map_entries("percentual_nulos_por_coluna"),
        lambda e, i: F.struct(
            (-e["value"]).alias("by_share"),
            i.alias("by_position"),
            e["key"].alias("rotulos"),
            e["value"].cast("decimal(38,2)").alias("valores"),
            severity_colour(e["value"]).alias("cores"),
        ),
    )
    points = report.select(F.array_sort(entries).alias("points"))
    return points.select(
        F.lit("nulos").alias("grafico"),
        *[F.to_json(F.col(f"points.{c}")).alias(c) for c in ("rotulos", "valores", "cores")],
    )
