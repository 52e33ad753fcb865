"""The whole batch: check, profile, publish, aggregate, report.

The transactions are read for the profile, for the rules, where these are checked, and for the one
join that both the flat view and the fact are taken from: large tables in a few rounds, each of which
reads them and joins a share of the cards, so that one round's shuffles are on disk at a time.
Everything else reads what was written before, and the joined rows are counted by the tasks that write them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylake.functions.masking import mask_strict
from tallylake.operators import (
    constraints,
    flat,
    interactions,
    profile,
    snowflake,
    star,
    validity,
)
from tallylake.plans import history, manifest, marts, report
from tallylake.schema import BUSINESS_KEY, Tables
from tallylake.sources import files, storage
from tallylake.workspace import discard, new_folder, shuffles_removed

# With so many valid transactions, they meet their cards in so many rounds.
ROUNDS = 4
ROUNDS_FROM = 1_000_000

DASHBOARD_TABLES = (
    "kpi_summary",
    "kpi_labels",
    "brand_mart",
    "sample_rows",
    "quality_headline",
    "quality_bars",
    "null_ranking",
    "chart_points",
    "null_series",
)


@dataclass(frozen=True)
class Layout:
    """Paths of everything a run publishes: in ``root``, but for what all runs in ``output`` share."""

    root: str
    output: str | None = None

    @property
    def flat_parquet(self) -> str:
        return f"{self.root}/movimento_flat.parquet"

    @property
    def flat_csv(self) -> str:
        return f"{self.root}/movimento_flat.csv"

    @property
    def brand_parquet(self) -> str:
        return f"{self.root}/analise_negocio_movimentacoes_por_bandeira.parquet"

    @property
    def brand_csv(self) -> str:
        return f"{self.root}/analise_negocio_movimentacoes_por_bandeira.csv"

    @property
    def report(self) -> str:
        return f"{self.root}/data_quality_report.json"

    @property
    def history(self) -> str:
        return f"{self.output or self.root}/quality_history"

    @property
    def rules(self) -> str:
        return f"{self.root}/constraint_violations"

    @property
    def dropped(self) -> str:
        return f"{self.root}/dropped_rows"

    def star(self, table: str) -> str:
        return f"{self.root}/star_schema/{table}.parquet"

    def snowflake(self, table: str) -> str:
        return f"{self.root}/snowflake_schema/{table}.parquet"

    def dashboard(self, table: str) -> str:
        return f"{self.root}/dashboard/{table}.parquet"


@dataclass(frozen=True)
class Outcome:
    layout: Layout
    report: dict
    flat_rows: int


def write_tables(tables: dict[str, DataFrame], path: Callable[[str], str]) -> None:
    """Replace every table of a star or snowflake; the fact is partitioned by month.

    On disk the fact has the month as a further, last column, ``mes``: readers prune by it, and
    :func:`read_fact` leaves it out.
    """
    for name, df in tables.items():
        if name == "fato_movimentacao":
            storage.write_by_month(df, path(name), "data_movimentacao")
        else:
            storage.write_table(df, path(name))


def write_star(tables: dict[str, DataFrame], layout: Layout) -> None:
    write_tables(tables, layout.star)


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """A written fact with the columns of the contract."""
    return spark.read.parquet(path).drop("mes")


def dropped_rows(valid_rows: int, fact_rows: int, flat_rows: int) -> list[tuple]:
    """(tabela, linhas_validas, linhas, descartadas): what the joins left out, by table."""
    return [
        ("fato_movimentacao", valid_rows, fact_rows, valid_rows - fact_rows),
        ("movimento_flat", valid_rows, flat_rows, valid_rows - flat_rows),
    ]


def _rounds(tables: Tables, rows: int) -> int:
    """In how many rounds transactions meet their cards: few rows in one, and keys of two types too."""
    held, referred = tables.cards.schema["id"].dataType, tables.movements.schema["id_cartao"].dataType
    alike = held == referred and (isinstance(held, T.IntegralType) or held == T.StringType())
    return ROUNDS if alike and rows >= ROUNDS_FROM else 1


def write_transactions(
    tables: Tables,
    members: DataFrame,
    masked: Callable[[DataFrame], DataFrame],
    layout: Layout,
    rounds: int = 1,
) -> dict[str, int]:
    """Write the fact and the flat view from one join of valid transactions and cards; their rows, ``fact`` and ``flat``.

    Each of the ``rounds`` joins the cards of its share of ids, hashed, with their transactions and adds to both
    tables. The shuffle files and the joined rows of one round are gone before the next, so they take only
    a share of the disk beside the tables themselves.
    """
    spark = tables.movements.sparkSession
    written = {"fact": 0, "flat": 0}
    for number in range(rounds):
        mode = "append" if number else "overwrite"

        def due(key: str, number: int = number) -> Column:
            # not the hash of the id alone: by that one the join spreads the cards of a heavy member
            return F.pmod(F.xxhash64(F.lit("round"), key), F.lit(rounds)) == number

        lookup = flat.card_lookup(masked(tables.cards.where(due("id"))), tables.accounts, members)
        # shares first: what else is worked out of a transaction is then worked out in one round only
        valid = validity.valid_rows(tables.movements.where(due("id_cartao")))
        together = flat.wide(valid, lookup)
        joined = new_folder(spark, "movements-wide")
        try:
            counted = storage.write_table(
                together, joined, {"fact": F.count(F.lit(1)), "flat": F.count_if(F.col("complete"))}
            )
            # the schema is given, since a table without rows may have no file to take it from
            wide = spark.read.schema(together.schema).parquet(joined)
            fact = layout.star("fato_movimentacao")
            storage.write_by_month(flat.fact_of(wide), fact, "data_movimentacao", mode=mode)
            storage.write_table(flat.as_contract(flat.view_of(wide)), layout.flat_parquet, mode=mode)
        finally:
            discard(spark, joined)
        written = {name: rows + counted[name] for name, rows in written.items()}
    return written


def run(
    tables: Tables,
    output: str,
    run_id: str | None = None,
    with_csv: bool = True,
    strict: bool = False,
    check_rules: bool = True,
    with_snowflake: bool = False,
    single_csv: bool = False,
) -> Outcome:
    """Run everything and return what was measured. A rerun takes the place of the run before.

    A run has a folder of its own, which the manifest names when all is written; readers go by the
    manifest, so a run that was cut short leaves the outputs of the run before as they are.
    ``strict`` hides card numbers, printed names and e-mails in all that is published. ``check_rules`` publishes the
    violations of every rule of the source system. ``single_csv`` writes the brand
    mart's CSV as one file in place of an ordered folder of files.
    """
    spark = tables.movements.sparkSession
    output = output.rstrip("/")
    layout = Layout(manifest.new_run(output), output)
    masked = mask_strict if strict else (lambda df: df)

    with shuffles_removed(spark):
        measured = profile.measure(tables.movements, BUSINESS_KEY)
        figures = measured.report().first()
        document = measured.document(figures)
        if check_rules:
            storage.write_table(constraints.summary(tables), layout.rules)

        counts = interactions.per_member(tables.interactions)
        storage.write_table(masked(star.dim_member(tables.members, counts)), layout.star("dim_associado"))
        storage.write_table(star.dim_account(tables.accounts), layout.star("dim_conta"))
        storage.write_table(masked(star.dim_card(tables.cards)), layout.star("dim_cartao"))

        # the member dimension is already masked and counted: read it back
        members = spark.read.parquet(layout.star("dim_associado"))
        written = write_transactions(tables, members, masked, layout, _rounds(tables, figures["validas"]))
        view = spark.read.parquet(layout.flat_parquet)
        if with_csv:
            storage.write_csv(view, layout.flat_csv)
        if with_snowflake:
            flakes = snowflake.build(tables)
            write_tables({name: masked(df) for name, df in flakes.items()}, layout.snowflake)

        storage.write_table(marts.brand_mart_of(view), layout.brand_parquet)
        brands = spark.read.parquet(layout.brand_parquet)
        order = [F.desc("valor_total"), F.asc("bandeira_cartao")]
        write_brands = storage.export_csv if single_csv else storage.write_csv_ordered
        write_brands(brands, layout.brand_csv, order)

        lost = dropped_rows(figures["validas"], written["fact"], written["flat"])
        storage.write_table(
            spark.createDataFrame(
                lost, "tabela string, linhas_validas bigint, linhas bigint, descartadas bigint"
            ),
            layout.dropped,
        )
        storage.write_document(spark, document, layout.report)
        if run_id is not None:
            history.record(files.read_report(spark, layout.report), run_id, layout.history)
        manifest.publish(spark, output, layout.root)
        return Outcome(layout, document, written["flat"])


def published(spark: SparkSession, output: str) -> Layout:
    """Paths of the run that is published in ``output``; raises when none is."""
    output = output.rstrip("/")
    return Layout(manifest.current(spark, output), output)


def dashboards(spark: SparkSession, output: str) -> dict[str, DataFrame]:
    """Dashboard tables by name from the published run; raises when an output is missing."""
    return _dashboards(spark, published(spark, output))


def _dashboards(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    storage.require(spark, [layout.flat_parquet, layout.brand_parquet, layout.report])
    view = spark.read.parquet(layout.flat_parquet)
    brands = spark.read.parquet(layout.brand_parquet)
    quality = files.read_report(spark, layout.report)
    kpis = marts.kpi_summary_of(view)
    return {
        "kpi_summary": kpis,
        "kpi_labels": marts.kpi_labels(kpis),
        "brand_mart": brands,
        "sample_rows": marts.sample_rows(view),
        "quality_headline": report.quality_headline(quality),
        "quality_bars": report.quality_bars(quality),
        "null_ranking": report.null_ranking(quality),
        "chart_points": report.chart_points(brands, quality),
        "null_series": report.null_series(quality),
    }


def write_dashboards(spark: SparkSession, output: str) -> list[str]:
    """Write every dashboard table beside the published run's other outputs; their paths."""
    layout = published(spark, output)
    tables = _dashboards(spark, layout)
    with shuffles_removed(spark):
        for name in DASHBOARD_TABLES:
            storage.write_table(tables[name], layout.dashboard(name))
    return [layout.dashboard(name) for name in DASHBOARD_TABLES]
