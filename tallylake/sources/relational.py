"""Relational source: one JDBC scan per table, split over the primary key."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

DRIVER_CLASS = "org.postgresql.Driver"


@dataclass(frozen=True)
class RelationalSource:
    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str = DRIVER_CLASS
    fetch_size: int = 10_000

    @classmethod
    def from_environment(cls, env: Mapping[str, str] | None = None) -> RelationalSource:
        """Settings from DB_HOST, DB_PORT, DB_NAME, DB_USER and DB_PASSWORD."""
        env = os.environ if env is None else env
        missing = [k for k in ("DB_HOST", "DB_PORT", "DB_NAME") if not env.get(k)]
        if missing:
            raise KeyError(f"not set: {', '.join(missing)}")
        return cls(
            url=f"jdbc:postgresql://{env['DB_HOST']}:{env['DB_PORT']}/{env['DB_NAME']}",
            user=env.get("DB_USER"),
            password=env.get("DB_PASSWORD"),
        )

    def options(self) -> dict[str, str]:
        known = {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "fetchsize": str(self.fetch_size),
            # the source columns are TIMESTAMP without time zone
            "preferTimestampNTZ": "true",
        }
        return {k: v for k, v in known.items() if v is not None}


@dataclass(frozen=True)
class KeyRange:
    """How to cut a scan: ``parts`` equal strides of ``column``.

    The bounds only place the cuts; rows outside them are still read.
    """

    column: str
    lower: int
    upper: int
    parts: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.parts),
        }


@dataclass(frozen=True)
class KeyCuts:
    """How to cut a scan at given keys, so that parts hold equally many rows, gaps or not.

    The cuts only place the parts: every row, also one with a NULL key, is in exactly one.
    """

    column: str
    cuts: tuple

    def predicates(self) -> list[str]:
        name = '"' + self.column.replace('"', '""') + '"'
        marks = [_literal(c) for c in sorted(set(self.cuts))]
        if not marks:
            return ["1 = 1"]
        middle = [f"{name} >= {low} AND {name} < {high}" for low, high in zip(marks, marks[1:])]
        return [f"{name} < {marks[0]} OR {name} IS NULL", *middle, f"{name} >= {marks[-1]}"]


def _literal(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(int(value))


def scan_options(source: RelationalSource, table: str, cut: KeyRange | None = None) -> dict:
    options = source.options() | {"dbtable": table}
    return options | cut.options() if cut else options


def read_table(
    spark: SparkSession,
    source: RelationalSource,
    table: str,
    cut: KeyRange | KeyCuts | None = None,
) -> DataFrame:
    """Lazy scan; filters and column selections are pushed into the database."""
    if isinstance(cut, KeyCuts):
        options = {k: v for k, v in source.options().items() if k != "url"}
        return spark.read.jdbc(source.url, table, predicates=cut.predicates(), properties=options)
    return spark.read.format("jdbc").options(**scan_options(source, table, cut)).load()


def key_range(
    spark: SparkSession, source: RelationalSource, table: str, parts: int, column: str = "id"
) -> KeyRange | None:
    """Ask the database for the key's extent; None when the table is empty."""
    query = f"(SELECT min({column}) AS lo, max({column}) AS hi FROM {table}) extent"
    lo, hi = read_table(spark, source, query).first()
    if lo is None:
        return None
    return KeyRange(column, int(lo), int(hi) + 1, parts)


def quantile_query(table: str, parts: int, column: str, sample_percent: float | None = None) -> str:
    """Standard SQL for the first key of each of ``parts`` equally large parts but the first.

    A sample of the table's pages is enough for large tables, since the cuts lose no row.
    """
    sample = f" TABLESAMPLE SYSTEM ({sample_percent:g})" if sample_percent is not None else ""
    dealt = (
        f"SELECT {column} AS k, ntile({int(parts)}) OVER (ORDER BY {column}) AS part "
        f"FROM {table}{sample} WHERE {column} IS NOT NULL"
    )
    return f"(SELECT min(k) AS cut FROM ({dealt}) dealt WHERE part > 1 GROUP BY part) cuts"


def key_cuts(
    spark: SparkSession,
    source: RelationalSource,
    table: str,
    parts: int,
    column: str = "id",
    sample_percent: float | None = None,
) -> KeyCuts:
    """Ask the database for quantiles of the key: at most ``parts`` - 1 values come back."""
    rows = read_table(spark, source, quantile_query(table, parts, column, sample_percent)).collect()
    return KeyCuts(column, tuple(r.cut for r in rows))
