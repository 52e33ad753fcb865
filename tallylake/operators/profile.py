"""Data-quality profile: validity, nulls per column and business-key copies.

``measure`` gets every figure from one scan and one shuffle. Rows are first
grouped by the business key; the groups carry their row count, so all totals
follow from the groups. Each task collapses its own copies before the shuffle,
so a key that holds a third of the table arrives as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tallylake.functions.presentation import percent
from tallylake.operators.validity import AMOUNT


def _named(column: str) -> Column:
    """A column by its literal name, even one with dots or backticks."""
    return F.col("`" + column.replace("`", "``") + "`")


def _total(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0))


@dataclass(frozen=True)
class Profile:
    """One lazy row of counts, and the reports derived from it."""

    columns: tuple[str, ...]
    counts: DataFrame

    def null_profile(self) -> DataFrame:
        """(posicao, coluna, nulos, percentual_nulos), one row per profiled column."""
        lines = [
            F.struct(
                F.lit(i).alias("posicao"),
                F.lit(name).alias("coluna"),
                F.col(f"nulls_{i}").alias("nulos"),
                percent(F.col(f"nulls_{i}"), F.col("total")).alias("percentual_nulos"),
            )
            for i, name in enumerate(self.columns)
        ]
        return self.counts.select(F.inline(F.array(*lines)))

    def duplicate_profile(self) -> DataFrame:
        copies = F.col("total") - F.col("distinct_keys")
        return self.counts.select(
            F.col("total").alias("total_registros"),
            copies.alias("total_duplicados"),
            percent(copies, F.col("total")).alias("percentual_duplicados"),
        )

    def report(self) -> DataFrame:
        """The whole report as one row; the null percentages are a map by column."""
        copies = F.col("total") - F.col("distinct_keys")
        pairs = []
        for i, name in enumerate(self.columns):
            pairs += [F.lit(name), percent(F.col(f"nulls_{i}"), F.col("total"))]
        return self.counts.select(
            F.col("total").alias("total_registros"),
            F.col("valid").alias("validas"),
            F.col("invalid").alias("invalidas"),
            F.col("missing").alias("sem_valor"),
            percent(F.col("invalid"), F.col("total")).alias(
                "movimentacoes_invalidas_descartadas_pct"
            ),
            F.create_map(*pairs).alias("percentual_nulos_por_coluna"),
            copies.alias("total_duplicados"),
            percent(copies, F.col("total")).alias("percentual_duplicados"),
        )

    def document(self, row: Row | None = None) -> dict:
        """The contract's JSON document, with the very figures of :meth:`report`.

        ``row`` is the report's row if it was fetched before; else it is fetched now.
        """
        row = row or self.report().first()
        shares = row["percentual_nulos_por_coluna"]
        return {
            "movimentacoes_invalidas_descartadas_pct": row["movimentacoes_invalidas_descartadas_pct"],
            "metricas_movimentacao_bruta": {
                "total_registros": row["total_registros"],
                "percentual_nulos_por_coluna": {name: shares[name] for name in self.columns},
                "percentual_duplicados": row["percentual_duplicados"],
                "total_duplicados": row["total_duplicados"],
            },
        }


@dataclass(frozen=True)
class _Tests:
    """What is counted of a table with these columns, and which of it travels with a key's group."""

    key: tuple[str, ...]
    all: dict[str, Column]
    loose: dict[str, Column]

    @classmethod
    def of(cls, columns: Sequence[str], key: Sequence[str], amount: str | None) -> _Tests:
        unknown = [k for k in key if k not in columns]
        if unknown or not key:
            raise ValueError(f"not a key of this table: {list(key)}")
        place = {name: f"c{i}" for i, name in enumerate(columns)}
        in_key = tuple(place[k] for k in key)
        tests = {f"nulls_{i}": F.col(f"c{i}").isNull() for i in range(len(columns))}
        uses = {f"nulls_{i}": f"c{i}" for i in range(len(columns))}
        verdicts = {"valid": F.lit(False), "invalid": F.lit(False), "missing": F.lit(False)}
        if amount in place:
            value = F.col(place[amount])
            verdicts = {"valid": value > 0, "invalid": value <= 0, "missing": value.isNull()}
            uses |= dict.fromkeys(verdicts, place[amount])
        tests |= verdicts
        # Tests on key columns are settled per group; only the others travel as counts.
        loose = {t: c for t, c in tests.items() if uses.get(t) and uses[t] not in in_key}
        return cls(in_key, tests, loose)


def key_groups(df: DataFrame, key: Sequence[str], amount: str | None = AMOUNT) -> DataFrame:
    """One row per business key with its rows and counts: the state that :func:`of_groups` reports from.

    Columns are named by their place in the table: ``c0``, ``c1``, ...
    """
    tests = _Tests.of(df.columns, key, amount)
    return (
        df.select([_named(name).alias(f"c{i}") for i, name in enumerate(df.columns)])
        .groupBy(*tests.key)
        .agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(t) for t, c in tests.loose.items()])
    )


def merged_groups(
    groups: DataFrame, columns: Sequence[str], key: Sequence[str], amount: str | None = AMOUNT
) -> DataFrame:
    """Groups of several parts of a table as the groups of the whole: a key's counts add up."""
    tests = _Tests.of(columns, key, amount)
    return groups.groupBy(*tests.key).agg(*[F.sum(c).alias(c) for c in ("n", *tests.loose)])


def of_groups(
    groups: DataFrame, columns: Sequence[str], key: Sequence[str], amount: str | None = AMOUNT
) -> Profile:
    """The profile of a table from its groups, one row per key."""
    tests = _Tests.of(columns, key, amount)
    n = F.col("n")
    counts = groups.agg(
        _total(n).alias("total"),
        F.count(F.lit(1)).alias("distinct_keys"),
        *[
            _total(F.col(t) if t in tests.loose else F.when(test, n).otherwise(0)).alias(t)
            for t, test in tests.all.items()
        ],
    )
    return Profile(tuple(columns), counts)


def measure(df: DataFrame, key: Sequence[str], amount: str | None = AMOUNT) -> Profile:
    """Profile ``df`` in one pass. NULLs in the key compare equal, as in DISTINCT."""
    return of_groups(key_groups(df, key, amount), df.columns, key, amount)


def null_counts(df: DataFrame) -> Profile:
    """Nulls of every column, without the key: no shuffle beyond one row per task."""
    columns = tuple(df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[
            F.count_if(_named(name).isNull()).alias(f"nulls_{i}")
            for i, name in enumerate(columns)
        ],
    )
    return Profile(columns, counts)


def key_copies(df: DataFrame, key: Sequence[str]) -> Profile:
    """Rows and distinct business keys only."""
    return Profile(
        (),
        df.groupBy(*[_named(k) for k in key])
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(_total(F.col("n")).alias("total"), F.count(F.lit(1)).alias("distinct_keys")),
    )


def distinct_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.select([_named(k) for k in key]).distinct()


def ranking(null_profile: DataFrame) -> DataFrame:
    """Columns from worst to best; equal shares keep the table's column order."""
    return null_profile.orderBy(F.desc("percentual_nulos"), F.asc("posicao"))


def worst_column(null_profile: DataFrame) -> DataFrame:
    """The column with the largest share of nulls; ``—`` with 0.0 when there is none."""
    rank = F.struct(F.col("percentual_nulos"), -F.col("posicao"))
    return null_profile.agg(F.max_by(F.struct("coluna", "percentual_nulos"), rank).alias("w")).select(
        F.coalesce("w.coluna", F.lit("—")).alias("coluna"),
        F.coalesce("w.percentual_nulos", F.lit(0.0)).alias("percentual_nulos"),
    )


def max_null_pct(null_profile: DataFrame) -> DataFrame:
    return null_profile.agg(
        F.coalesce(F.max("percentual_nulos"), F.lit(0.0)).alias("maior_percentual_nulos")
    )
