"""Flat view: one row per valid transaction with card, account and member columns.

The three lookups are joined to each other first, at card grain. The
transactions, by far the largest table, then move once, on the card id,
instead of once per lookup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylake.operators import interactions, star, validity
from tallylake.operators.skew import balanced_join
from tallylake.schema import AMOUNT, Tables
from tallylake.sources.bucketed import Bucketed

# Fixed values of the output contract, in order.
COLUMNS = (
    "id_associado",
    "nome",
    "sobrenome",
    "cpf",
    "idade_associado",
    "vlr_transacao_movimento",
    "des_transacao_movimento",
    "data_movimentacao",
    "numero_cartao",
    "nome_impresso_cartao",
    "bandeira_cartao",
    "tipo_conta",
    "qtd_interacoes_historico",
)

# Published as text.
TEXT_COLUMNS = ("idade_associado", "vlr_transacao_movimento", "data_movimentacao")


def card_lookup(cards: DataFrame, accounts: DataFrame, members: DataFrame) -> DataFrame:
    """Every card with the columns of its account and member, NULL where it misses them.

    ``complete`` says whether it has both. ``members`` is the member dimension, already masked
    and counted. The member is the card's own, which need not be the account's.
    """
    held = cards.select(
        F.col("id").alias("profile_card"),
        F.col("id_conta").alias("card_account"),
        F.col("id_associado").alias("card_member"),
        F.col("num_cartao").alias("numero_cartao"),
        F.col("nom_impresso").alias("nome_impresso_cartao"),
        F.col("bandeira").alias("bandeira_cartao"),
    )
    kinds = accounts.select(F.col("id").alias("account_id"), F.col("tipo").alias("tipo_conta"))
    owned = balanced_join(
        held, members.drop("email"), "card_member", "id_associado", F.col("profile_card"), "left"
    )
    known = owned.join(kinds, F.col("card_account") == F.col("account_id"), "left")
    complete = F.col("account_id").isNotNull() & F.col("id_associado").isNotNull()
    return known.withColumn("complete", complete).drop("account_id")


def card_profile(cards: DataFrame, accounts: DataFrame, members: DataFrame) -> DataFrame:
    """Cards with their account and member; cards that miss either are left out."""
    known = card_lookup(cards, accounts, members).where("complete")
    return known.drop("complete", "card_account", "card_member")


def profile_of(tables: Tables) -> DataFrame:
    counts = interactions.per_member(tables.interactions)
    return card_profile(
        tables.cards, tables.accounts, star.dim_member(tables.members, counts)
    )


def _moved(valid: DataFrame, *more: str) -> DataFrame:
    return valid.select(
        "id_cartao",
        F.col("vlr_transacao").alias("vlr_transacao_movimento"),
        F.col("des_transacao").alias("des_transacao_movimento"),
        "data_movimentacao",
        *more,
    )


def attach(valid: DataFrame, profile: DataFrame) -> DataFrame:
    """Typed flat view of already valid transactions."""
    joined = _moved(valid).join(profile, F.col("id_cartao") == F.col("profile_card"), "inner")
    return joined.select(*COLUMNS)


def wide(valid: DataFrame, lookup: DataFrame) -> DataFrame:
    """Valid transactions with all that the flat view and the fact take from their card.

    One move of the transactions for both; ``complete`` marks the rows of the flat view.
    """
    return _moved(valid, "id").join(lookup, F.col("id_cartao") == F.col("profile_card"), "inner")


def view_of(wide_rows: DataFrame) -> DataFrame:
    """The typed flat view from :func:`wide`."""
    return wide_rows.where("complete").select(*COLUMNS)


def fact_of(wide_rows: DataFrame, *more: str) -> DataFrame:
    """The star's fact from :func:`wide`: rows without an account or member too."""
    return wide_rows.select(
        F.col("id").alias("id_movimentacao"),
        "id_cartao",
        F.col("card_account").alias("id_conta"),
        F.col("card_member").alias("id_associado"),
        F.col("vlr_transacao_movimento").alias("vlr_transacao"),
        F.col("des_transacao_movimento").alias("des_transacao"),
        "data_movimentacao",
        *more,
    )


def build(tables: Tables) -> DataFrame:
    """Typed flat view: amounts are decimals and moments are timestamps."""
    return attach(validity.valid_rows(tables.movements), profile_of(tables))


def build_bucketed(movements: Bucketed, tables: Tables) -> DataFrame:
    """The typed flat view from transactions that were written in buckets by card.

    The buckets are joined where they lie: only the card profiles are shuffled. Transactions of heavy cards
    meet the profiles of those cards, at most one per bucket of the table, in a broadcast.
    """
    profile = profile_of(tables)
    few = profile.join(
        F.broadcast(movements.heavy_keys), F.col("profile_card") == F.col("heavy_key"), "left_semi"
    )
    light = attach(validity.valid_rows(movements.light), profile)
    return light.unionByName(attach(validity.valid_rows(movements.heavy), F.broadcast(few)))


def as_contract(flat: DataFrame) -> DataFrame:
    """The published form, with age, amount and moment as text."""
    return flat.withColumns({c: F.col(c).cast("string") for c in TEXT_COLUMNS})


def as_typed(published: DataFrame) -> DataFrame:
    """Undo :func:`as_contract`. The text came from exact types, so nothing is lost.

    Text that is not a number or a moment fails the job, here as in the marts: as a NULL it
    would vanish from every total.
    """
    return published.withColumns(
        {
            "idade_associado": F.col("idade_associado").cast("int"),
            "vlr_transacao_movimento": F.col("vlr_transacao_movimento").cast(AMOUNT),
            "data_movimentacao": F.col("data_movimentacao").cast("timestamp_ntz"),
        }
    )
