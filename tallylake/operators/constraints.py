"""The source system's constraints, verified by jobs.

Files in a lake enforce nothing. Each check returns (…, violations) rows for
every rule, zero included; the ``rows_*`` functions return the offending rows.
Keys are counted in each task before they are shuffled, so one key that holds
much of a table costs one row per task.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylake.operators import key_states
from tallylake.operators.skew import rows_with_key_in
from tallylake.schema import ACCOUNT, CARD, FOREIGN_KEYS, SPECS, ForeignKey, Tables


def _stack(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _key_counts(df: DataFrame, column: str) -> DataFrame:
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("key"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _repeats(df: DataFrame, table: str, column: str) -> DataFrame:
    n = F.col("n")
    return _key_counts(df, column).agg(
        F.lit(table).alias("tabela"),
        F.lit(column).alias("coluna"),
        F.count_if(n > 1).alias("chaves_repetidas"),
        F.coalesce(F.sum(n - 1), F.lit(0)).alias("linhas_excedentes"),
    )


def primary_keys(tables: Tables) -> DataFrame:
    """(tabela, coluna, chaves_repetidas, linhas_excedentes) per primary key."""
    frames = tables.by_name()
    return _stack(
        _repeats(frames[spec.name], spec.name, spec.primary_key)
        for spec in SPECS.values()
        if spec.primary_key
    )


def unique_columns(tables: Tables) -> DataFrame:
    """The same for columns declared UNIQUE."""
    frames = tables.by_name()
    return _stack(
        _repeats(frames[spec.name], spec.name, column)
        for spec in SPECS.values()
        for column in spec.unique
    )


def rows_with_repeated(df: DataFrame, column: str) -> DataFrame:
    """All rows of every key that occurs more than once."""
    return rows_with_key_in(df, column, _key_counts(df, column).where(F.col("n") > 1))


def _per_column(df: DataFrame, table: str, tests: dict, value: str, extra=None) -> DataFrame:
    """One aggregate over the table, turned into one row per tested column."""
    names = list(tests)
    counts = df.agg(*[F.count_if(tests[c]).alias(f"t{i}") for i, c in enumerate(names)])
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(table).alias("tabela"),
                        F.lit(c).alias("coluna"),
                        *([F.lit(extra[c]).alias("limite")] if extra else []),
                        F.col(f"t{i}").alias(value),
                    )
                    for i, c in enumerate(names)
                ]
            )
        )
    )


def required_columns(tables: Tables) -> DataFrame:
    """(tabela, coluna, nulos) per NOT NULL column; one pass per table."""
    frames = tables.by_name()
    return _stack(
        _per_column(
            frames[spec.name],
            spec.name,
            {c: F.col(c).isNull() for c in spec.required},
            "nulos",
        )
        for spec in SPECS.values()
        if spec.required
    )


def rows_with_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def text_lengths(tables: Tables) -> DataFrame:
    """(tabela, coluna, limite, excedentes) per bounded text column; one pass per table."""
    frames = tables.by_name()
    return _stack(
        _per_column(
            frames[spec.name],
            spec.name,
            {c.name: F.length(c.name) > c.max_length for c in spec.bounded},
            "excedentes",
            {c.name: c.max_length for c in spec.bounded},
        )
        for spec in SPECS.values()
        if spec.bounded
    )


def rows_longer_than(df: DataFrame, column: str, limit: int) -> DataFrame:
    return df.where(F.length(column) > limit)


def _orphans(tables: Tables, fk: ForeignKey) -> DataFrame:
    frames = tables.by_name()
    parent = frames[fk.parent].select(F.col("id").alias("parent_id")).distinct()
    lost = _key_counts(frames[fk.child], fk.column).join(
        parent, F.col("key") == F.col("parent_id"), "left_anti"
    )
    return lost.agg(
        F.lit(fk.child).alias("tabela"),
        F.lit(fk.column).alias("coluna"),
        F.lit(fk.parent).alias("referencia"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("orfas"),
    )


def foreign_keys(tables: Tables) -> DataFrame:
    """(tabela, coluna, referencia, orfas) per reference; a NULL reference is no orphan."""
    return _stack(_orphans(tables, fk) for fk in FOREIGN_KEYS)


def rows_without_parent(tables: Tables, fk: ForeignKey) -> DataFrame:
    """All rows of the child whose reference leads nowhere.

    Both inputs come straight from their shuffle, so AQE can cut the partition
    of a reference, such as a placeholder id, that a large share of rows hold.
    """
    frames = tables.by_name()
    parent = frames[fk.parent].select(F.col("id").alias("parent_id"))
    return frames[fk.child].where(F.col(fk.column).isNotNull()).join(
        parent, F.col(fk.column) == F.col("parent_id"), "left_anti"
    )


def cards_of_other_members(tables: Tables) -> DataFrame:
    """Cards whose member is not the member of their account, with both ids."""
    frames = tables.by_name()
    accounts = frames[ACCOUNT].select(
        F.col("id").alias("account_id"), F.col("id_associado").alias("id_associado_conta")
    )
    return (
        frames[CARD]
        .join(accounts, F.col("id_conta") == F.col("account_id"), "inner")
        .where(~F.col("id_associado").eqNullSafe(F.col("id_associado_conta")))
        .select(
            F.col("id").alias("id_cartao"), "id_conta", "id_associado", "id_associado_conta"
        )
    )


def member_consistency(tables: Tables) -> DataFrame:
    return cards_of_other_members(tables).agg(
        F.count(F.lit(1)).alias("cartoes_divergentes")
    )


def summary(tables: Tables) -> DataFrame:
    """(regra, tabela, coluna, violacoes) for every rule of every table; each table is read once."""
    return key_states.verdicts(key_states.state(tables))
