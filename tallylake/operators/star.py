"""Star schema: three dimensions over all source rows and one fact of valid transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylake.functions.masking import mask_member
from tallylake.operators import interactions, validity
from tallylake.schema import Tables

# The names published below are fixed values of the output contract.


def dim_member(members: DataFrame, counts: DataFrame) -> DataFrame:
    """Masked members with their interaction count, NULL for members without any.

    ``counts`` has one row per member, so the join cannot multiply members.
    """
    tally = counts.select(
        F.col("associado_id").alias("tally_member"),
        F.col("qtd_interacoes").alias("qtd_interacoes_historico"),
    )
    published = mask_member(members).select(
        F.col("id").alias("id_associado"),
        "nome",
        "sobrenome",
        F.col("idade").alias("idade_associado"),
        "email",
        "cpf",
    )
    return published.join(
        tally, F.col("id_associado") == F.col("tally_member"), "left"
    ).drop("tally_member")


def dim_account(accounts: DataFrame) -> DataFrame:
    return accounts.select(
        F.col("id").alias("id_conta"),
        F.col("tipo").alias("tipo_conta"),
        F.col("data_criacao").alias("data_criacao_conta"),
    )


def dim_card(cards: DataFrame) -> DataFrame:
    return cards.select(
        F.col("id").alias("id_cartao"),
        "num_cartao",
        F.col("nom_impresso").alias("nome_impresso_cartao"),
        "bandeira",
        F.col("data_criacao").alias("data_criacao_cartao"),
    )


def fact_movement(valid: DataFrame, cards: DataFrame, *more: Column) -> DataFrame:
    """Valid transactions with the card's account and member as foreign keys.

    Only the card is looked up: a transaction whose account or member is
    missing is still a fact. ``more`` are further columns of the card to publish. Both inputs
    are shuffled straight into the join, so AQE can cut the partition of a card
    that holds most transactions.
    """
    owner = cards.select(F.col("id").alias("owner_card"), "id_conta", "id_associado", *more)
    further = [c for c in owner.columns if c not in ("owner_card", "id_conta", "id_associado")]
    owned = valid.join(owner, F.col("id_cartao") == F.col("owner_card"), "inner")
    return owned.select(
        F.col("id").alias("id_movimentacao"),
        "id_cartao",
        "id_conta",
        "id_associado",
        "vlr_transacao",
        "des_transacao",
        "data_movimentacao",
        *further,
    )


def assemble(
    members: DataFrame,
    accounts: DataFrame,
    cards: DataFrame,
    valid: DataFrame,
    counts: DataFrame,
) -> dict[str, DataFrame]:
    return {
        "dim_associado": dim_member(members, counts),
        "dim_conta": dim_account(accounts),
        "dim_cartao": dim_card(cards),
        "fato_movimentacao": fact_movement(valid, cards),
    }


def build(tables: Tables) -> dict[str, DataFrame]:
    """The four tables by name, lazy, straight from the sources."""
    return assemble(
        tables.members,
        tables.accounts,
        tables.cards,
        validity.valid_rows(tables.movements),
        interactions.per_member(tables.interactions),
    )
