"""Put known defects into clean transactions, by rule and not at random.

A rule over key columns gives the same defects on every run and in any engine,
so the quality figures measured afterwards can be checked exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylake.schema import AMOUNT


def inject(
    movements: DataFrame,
    negative: Column,
    missing: Column,
    undescribed: Column,
    copied: Column,
    copy_id: Column,
) -> DataFrame:
    """Negate, blank out and repeat the rows the rules select.

    The copies come out of the same scan as the originals, not from a second one.
    """
    amount = F.col("vlr_transacao")
    spoiled = movements.withColumns(
        {
            "vlr_transacao": F.when(missing, F.lit(None))
            .when(negative, -amount)
            .otherwise(amount)
            .cast(AMOUNT),
            "des_transacao": F.when(undescribed, F.lit(None)).otherwise(F.col("des_transacao")),
            "is_copied": copied,
        }
    )
    repeated = spoiled.withColumn(
        "is_copy",
        F.explode(
            F.when(F.col("is_copied"), F.array(F.lit(False), F.lit(True))).otherwise(
                F.array(F.lit(False))
            )
        ),
    )
    return repeated.withColumn("id", F.when(F.col("is_copy"), copy_id).otherwise(F.col("id"))).drop(
        "is_copied", "is_copy"
    )
