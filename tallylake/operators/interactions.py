"""Interaction log rolled up to one row per member."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def per_member(interactions: DataFrame) -> DataFrame:
    """(associado_id, qtd_interacoes). Counts are combined in each task before the shuffle."""
    return interactions.groupBy("associado_id").agg(F.count(F.lit(1)).alias("qtd_interacoes"))
