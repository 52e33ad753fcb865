"""One query per operator over the given tables. Column names match the SQL oracles."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import fields, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.functions import masking, pseudonyms
from tallylake.functions.presentation import brl, percent
from tallylake.operators import (
    constraints,
    flat,
    interactions,
    key_states,
    keyed_table,
    profile,
    reload,
    seen_keys,
    snowflake,
    star,
    validity,
)
from tallylake.plans import batch, history, marts, report
from tallylake.schema import BUSINESS_KEY, FOREIGN_KEYS
from tallylake.sources import bucketed, documents, files, storage
from tallylake.workspace import new_folder
from testbed import fixtures

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Not a secret: the oracle has it too.
TESTBED_SECRET = b"known to the oracle"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- sources and sinks -------------------------------------------------------


@query
def scan_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "interactions")
    storage.write_json(fixtures.interactions(spark, sf_dir), path)
    schema = fixtures.interactions(spark, sf_dir).schema
    log = documents.read_json_lines(spark, path, schema)
    return log.select("associado_id", "canal", "data_interacao", F.col("metadata.k").alias("k"))


@query
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "flat")
    storage.write_table(flat.as_contract(flat.build(fixtures.load(spark, sf_dir))), path)
    return spark.read.parquet(path)


@query
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "flat-csv")
    storage.write_csv(flat.as_contract(flat.build(fixtures.load(spark, sf_dir))), path)
    return flat.as_typed(files.read_csv(spark, path)).withColumns(
        {
            "id_associado": F.col("id_associado").cast("bigint"),
            "qtd_interacoes_historico": F.col("qtd_interacoes_historico").cast("bigint"),
        }
    )


@query
def report_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{new_folder(spark, 'report')}/data_quality_report.json"
    storage.write_document(spark, _profile(spark, sf_dir).document(), path)
    row = files.read_report(spark, path)
    return row.select(
        "movimentacoes_invalidas_descartadas_pct",
        "total_registros",
        "percentual_duplicados",
        "total_duplicados",
        F.explode("percentual_nulos_por_coluna").alias("coluna", "percentual_nulos"),
    )


@query
def star_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = batch.Layout(new_folder(spark, "star"))
    tables = star.build(fixtures.load(spark, sf_dir))
    batch.write_star(tables, layout)
    key = {
        "dim_associado": "id_associado",
        "dim_conta": "id_conta",
        "dim_cartao": "id_cartao",
        "fato_movimentacao": "id_cartao",
    }
    counts = [
        spark.read.parquet(layout.star(name)).agg(
            F.lit(name).alias("tabela"),
            F.count(F.lit(1)).alias("linhas"),
            F.sum(key[name]).alias("soma_chaves"),
        )
        for name in tables
    ]
    return reduce(DataFrame.unionByName, counts)


def _run(spark: SparkSession, sf_dir: str, **options) -> batch.Layout:
    options = {"with_csv": False, "check_rules": False} | options
    return batch.run(fixtures.load(spark, sf_dir), new_folder(spark, "run"), **options).layout


@query
def run_dim_associado(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each table as a whole run of the batch leaves it, every column."""
    return spark.read.parquet(_run(spark, sf_dir).star("dim_associado"))


@query
def run_dim_conta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_run(spark, sf_dir).star("dim_conta"))


@query
def run_dim_cartao(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_run(spark, sf_dir).star("dim_cartao"))


@query
def run_fato_movimentacao(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch.read_fact(spark, _run(spark, sf_dir).star("fato_movimentacao"))


@query
def run_movimento_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_run(spark, sf_dir).flat_parquet)


@query
def run_brand_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = files.read_csv(spark, _run(spark, sf_dir).brand_csv)
    return text.select(
        "bandeira_cartao",
        F.col("qtd_movimentacoes").cast("bigint").alias("qtd_movimentacoes"),
        F.col("valor_total").cast("double").alias("valor_total"),
    )


@query
def run_chart_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = _run(spark, sf_dir)
    batch.write_dashboards(spark, layout.output)
    return spark.read.parquet(layout.dashboard("chart_points"))


@query
def run_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The violations that a run publishes, on sources that break every rule."""
    outcome = batch.run(fixtures.load_broken(spark, sf_dir), new_folder(spark, "run"), with_csv=False)
    return spark.read.parquet(outcome.layout.rules)


@query
def run_dropped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid transactions that a run's joins leave out, on the same sources."""
    broken = fixtures.load_broken(spark, sf_dir)
    outcome = batch.run(broken, new_folder(spark, "run"), with_csv=False, check_rules=False)
    return spark.read.parquet(outcome.layout.dropped)


@query
def dashboard_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample as the dashboard gets it: a whole run, then read from its outputs."""
    outcome = batch.run(fixtures.load(spark, sf_dir), new_folder(spark, "run"))
    shown = batch.dashboards(spark, outcome.layout.output)["sample_rows"]
    return shown.withColumn(
        "vlr_transacao_movimento", F.col("vlr_transacao_movimento").cast("decimal(15,2)")
    ).withColumn("data_movimentacao", F.col("data_movimentacao").cast("timestamp_ntz"))


# --- validity and profile ----------------------------------------------------


def _profile(spark: SparkSession, sf_dir: str) -> profile.Profile:
    return profile.measure(fixtures.movements(spark, sf_dir), BUSINESS_KEY)


@query
def defect_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.movements(spark, sf_dir)


@query
def valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validity.valid_rows(fixtures.movements(spark, sf_dir))


@query
def invalid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validity.invalid_rows(fixtures.movements(spark, sf_dir))


@query
def validity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validity.summary(fixtures.movements(spark, sf_dir))


@query
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_counts(fixtures.movements(spark, sf_dir)).null_profile()


@query
def duplicate_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.key_copies(fixtures.movements(spark, sf_dir), BUSINESS_KEY).duplicate_profile()


@query
def distinct_business_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distinct_keys(fixtures.movements(spark, sf_dir), BUSINESS_KEY)


def _report_lines(row: DataFrame) -> DataFrame:
    shares = F.col("percentual_nulos_por_coluna")
    columns = ("id", *[k for k in BUSINESS_KEY])
    return row.select(
        "total_registros",
        "validas",
        "invalidas",
        "sem_valor",
        "movimentacoes_invalidas_descartadas_pct",
        "total_duplicados",
        "percentual_duplicados",
        *[shares[c].alias(f"pct_nulos_{c}") for c in columns],
    )


@query
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report_lines(_profile(spark, sf_dir).report())


@query
def max_null_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.max_null_pct(null_profile(spark, sf_dir))


@query
def worst_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.worst_column(null_profile(spark, sf_dir))


# --- flat, star and snowflake ------------------------------------------------


@query
def interactions_per_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.per_member(fixtures.interactions(spark, sf_dir))


@query
def flat_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat.build(fixtures.load(spark, sf_dir))


@query
def flat_view_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat view from transactions written in buckets by card."""
    tables = fixtures.load(spark, sf_dir)
    path = new_folder(spark, "movements-bucketed")
    bucketed.write(tables.movements, path, "id_cartao", 8)
    return flat.build_bucketed(bucketed.read(spark, path), tables)


@query
def flat_contract_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat.as_contract(flat.build(fixtures.load(spark, sf_dir)))


@query
def dim_associado(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.build(fixtures.load(spark, sf_dir))["dim_associado"]


@query
def dim_conta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.build(fixtures.load(spark, sf_dir))["dim_conta"]


@query
def dim_cartao(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.build(fixtures.load(spark, sf_dir))["dim_cartao"]


@query
def fato_movimentacao(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.build(fixtures.load(spark, sf_dir))["fato_movimentacao"]


@query
def dim_bandeira(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snowflake.build(fixtures.load(spark, sf_dir))["dim_bandeira"]


@query
def dim_tempo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snowflake.build(fixtures.load(spark, sf_dir))["dim_tempo"]


@query
def fato_com_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snowflake's fact with its two new keys."""
    fact = snowflake.build(fixtures.load(spark, sf_dir))["fato_movimentacao"]
    return fact.select("id_movimentacao", "id_cartao", "id_data", "id_bandeira")


# --- marts and report tables -------------------------------------------------


@query
def brand_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.brand_mart(fixtures.load(spark, sf_dir))


@query
def brand_mart_from_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.brand_mart_of(parquet_roundtrip(spark, sf_dir))


@query
def kpi_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.kpi_summary(fixtures.load(spark, sf_dir))


@query
def kpi_summary_from_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.kpi_summary_of(parquet_roundtrip(spark, sf_dir))


@query
def kpi_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.kpi_labels(kpi_summary(spark, sf_dir))


@query
def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.sample_rows(flat.build(fixtures.load(spark, sf_dir)))


@query
def null_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.null_ranking(_profile(spark, sf_dir).report())


@query
def quality_headline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.quality_headline(_profile(spark, sf_dir).report())


@query
def quality_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.quality_bars(_profile(spark, sf_dir).report())


@query
def chart_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.chart_points(brand_mart(spark, sf_dir), _profile(spark, sf_dir).report())


@query
def null_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.null_series(_profile(spark, sf_dir).report())


@query
def severity_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of invalid transactions per card, with its severity."""
    amount = F.col("vlr_transacao")
    shares = (
        fixtures.movements(spark, sf_dir)
        .groupBy("id_cartao")
        .agg(F.count(F.lit(1)).alias("total"), F.count_if(amount <= 0).alias("invalidas"))
        .select("id_cartao", percent(F.col("invalidas"), F.col("total")).alias("percentual"))
    )
    return report.with_severity(shares, "percentual")


# --- scalar functions --------------------------------------------------------


@query
def mask_cpf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.members(spark, sf_dir).select("id", masking.mask_tax_id(F.col("cpf")).alias("cpf"))


@query
def mask_surname(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.members(spark, sf_dir).select(
        "id", "nome", masking.mask_surname(F.col("sobrenome")).alias("sobrenome")
    )


@query
def mask_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members' tax ids and e-mails as pseudonyms under a secret of the test bed."""
    members = fixtures.members(spark, sf_dir)
    return pseudonyms.mask_keyed(members, TESTBED_SECRET).select("id", "nome", "email", "cpf")


@query
def mask_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stricter masks on every card and its holder's e-mail."""
    cards = fixtures.cards(spark, sf_dir).select("id", "num_cartao", "nom_impresso", "id_associado")
    mail = fixtures.members(spark, sf_dir).select(F.col("id").alias("member"), "email")
    held = cards.join(mail, F.col("id_associado") == F.col("member"), "inner")
    return masking.mask_strict(held).select("id", "num_cartao", "nom_impresso", "email")


@query
def format_brl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.movements(spark, sf_dir).select(
        "id", brl(F.col("vlr_transacao")).alias("valor_formatado")
    )


# --- constraints -------------------------------------------------------------


@query
def check_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.primary_keys(fixtures.load_broken(spark, sf_dir))


@query
def check_cpf_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.unique_columns(fixtures.load_broken(spark, sf_dir))


@query
def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.required_columns(fixtures.load_broken(spark, sf_dir))


@query
def check_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.foreign_keys(fixtures.load_broken(spark, sf_dir))


@query
def check_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.text_lengths(fixtures.load_broken(spark, sf_dir))


@query
def check_member_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.cards_of_other_members(fixtures.load_broken(spark, sf_dir))


@query
def offending_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(regra, id, coluna): the rows behind K1 to K5, one rule of each kind."""
    t = fixtures.load_broken(spark, sf_dir)
    fk = next(k for k in FOREIGN_KEYS if k.column == "id_cartao")

    def named(rule: str, rows: DataFrame, column: str) -> DataFrame:
        return rows.select(
            F.lit(rule).alias("regra"), F.col("id").cast("string").alias("id"), F.lit(column).alias("coluna")
        )

    return (
        named("primary_key", constraints.rows_with_repeated(t.movements, "id"), "id")
        .unionByName(named("unique", constraints.rows_with_repeated(t.members, "cpf"), "cpf"))
        .unionByName(
            named("not_null", constraints.rows_with_null(t.movements, "vlr_transacao"), "vlr_transacao")
        )
        .unionByName(named("foreign_key", constraints.rows_without_parent(t, fk), "id_cartao"))
        .unionByName(
            named("length", constraints.rows_longer_than(t.cards, "nom_impresso", 100), "nom_impresso")
        )
    )


@query
def check_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.summary(fixtures.load_broken(spark, sf_dir))


@query
def check_all_by_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions in three loads, the first with the other tables: states kept per load and added up."""
    tables = fixtures.load_broken(spark, sf_dir)
    path = new_folder(spark, "key-states")
    load = F.pmod(F.xxhash64("id"), F.lit(3))
    for part in range(3):
        piece = replace(tables, movements=tables.movements.where(load == part))
        if part:
            nothing = {f.name: getattr(tables, f.name).limit(0) for f in fields(tables) if f.name != "movements"}
            piece = replace(piece, **nothing)
        key_states.record(key_states.state(piece), f"load-{part}", path)
    return key_states.verdicts(key_states.recorded(spark, path))


@query
def broken_star_and_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With orphans present: the fact keeps rows without an account, the flat view does not."""
    tables = fixtures.load_broken(spark, sf_dir)
    fact = star.build(tables)["fato_movimentacao"].agg(
        F.lit("fato_movimentacao").alias("tabela"), F.count(F.lit(1)).alias("linhas")
    )
    view = flat.build(tables).agg(
        F.lit("movimento_flat").alias("tabela"), F.count(F.lit(1)).alias("linhas")
    )
    return fact.unionByName(view)


# --- reloads and history -----------------------------------------------------


@query
def dedup_movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reload.first_per_key(fixtures.movements(spark, sf_dir), BUSINESS_KEY)


@query
def idempotent_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards loaded twice with a batch that renames and repeats the recent ones, then an old load again."""
    target = fixtures.cards(spark, sf_dir)
    recent = target.where(F.col("data_criacao") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    later = F.col("data_criacao") + F.expr("interval 1 day")
    renamed = recent.withColumns({"nom_impresso": F.lower("nom_impresso"), "data_criacao": later})
    loaded = recent.unionByName(renamed)
    once = reload.upsert(target, loaded, ["id"], ["data_criacao"])
    twice = reload.upsert(once, loaded, ["id"], ["data_criacao"])
    earlier = F.col("data_criacao") - F.expr("interval 9 days")
    stale = target.withColumns({"nom_impresso": F.lit("STALE"), "data_criacao": earlier})
    return reload.upsert(twice, stale, ["id"], ["data_criacao"])


@query
def merge_touched_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loads of ``idempotent_merge`` into a table of buckets on disk."""
    target = fixtures.cards(spark, sf_dir)
    recent = target.where(F.col("data_criacao") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    later = F.col("data_criacao") + F.expr("interval 1 day")
    renamed = recent.withColumns({"nom_impresso": F.lower("nom_impresso"), "data_criacao": later})
    earlier = F.col("data_criacao") - F.expr("interval 9 days")
    stale = target.withColumns({"nom_impresso": F.lit("STALE"), "data_criacao": earlier})
    path = new_folder(spark, "cards")
    keyed_table.create(target, path, ["id"], ["data_criacao"], buckets=16)
    loaded = recent.unionByName(renamed)
    for batch_rows in (loaded, loaded, stale):
        keyed_table.merge(spark, path, batch_rows)
    return keyed_table.read(spark, path)


@query
def dedup_by_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions in three loads, in order of their ids; the last one is loaded twice."""
    rows = fixtures.movements(spark, sf_dir)
    place = F.lower(F.substring("id", 1, 1))
    index, target = new_folder(spark, "seen-index"), new_folder(spark, "seen-rows")
    parts = [place < "3", (place >= "3") & (place < "6"), place >= "6"]
    for number, part in enumerate([*parts, parts[-1]]):
        seen_keys.load(rows.where(part), f"load-{min(number, 2)}", index, target, BUSINESS_KEY)
    return seen_keys.read(spark, target)


@query
def quality_report_by_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of three loads, one of them recorded twice, from their states."""
    rows = fixtures.movements(spark, sf_dir)
    path = new_folder(spark, "profile-states")
    part = F.pmod(F.xxhash64("id"), F.lit(3))
    for number in (0, 1, 2, 2):
        history.record_load(rows.where(part == number), f"load-{number}", path, BUSINESS_KEY)
    return _report_lines(history.profile_of_loads(spark, path, rows.columns, BUSINESS_KEY).report())


@query
def insert_new_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members who hold a card are on file already; then all are loaded with another age, twice over."""
    everybody = fixtures.members(spark, sf_dir)
    holders = fixtures.cards(spark, sf_dir).select(F.col("id_associado").alias("holder")).distinct()
    on_file = everybody.join(holders, F.col("id") == F.col("holder"), "left_semi")
    older = everybody.withColumn("idade", F.col("idade") + 100)
    loaded = reload.insert_new(on_file, older.unionByName(older), ["id"])
    return reload.insert_new(loaded, older, ["id"])


@query
def quality_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs, the first one recorded twice."""
    path = new_folder(spark, "history")
    raw = fixtures.movements(spark, sf_dir)
    clean = reload.first_per_key(raw, BUSINESS_KEY)
    for run_id, rows in (("bruto", raw), ("sem_copias", clean), ("bruto", raw)):
        history.record(profile.measure(rows, BUSINESS_KEY).report(), run_id, path)
    return history.read(spark, path)
