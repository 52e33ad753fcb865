"""The five source tables, their keys and their constraints, stated as data.

Readers take their ``StructType`` from here and the constraint checks take
their rules from here, so a column is described exactly once. Column names
are part of the output contract and stay in Portuguese.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

MEMBER = "associado"
ACCOUNT = "conta"
CARD = "cartao"
MOVEMENT = "movimentacao"
INTERACTION = "historico_interacoes"

AMOUNT = T.DecimalType(15, 2)

# Two transactions that agree on all of these are copies of one another.
BUSINESS_KEY = ("id_cartao", "vlr_transacao", "des_transacao", "data_movimentacao")


@dataclass(frozen=True)
class Column:
    name: str
    type: T.DataType
    required: bool = True
    max_length: int | None = None


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[Column, ...]
    primary_key: str | None = "id"
    unique: tuple[str, ...] = ()

    @property
    def struct(self) -> T.StructType:
        # Files do not enforce NOT NULL, so every field is read as nullable and
        # the NOT NULL rule is verified by a job instead.
        return T.StructType([T.StructField(c.name, c.type, True) for c in self.columns])

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if c.required]

    @property
    def bounded(self) -> list[Column]:
        return [c for c in self.columns if c.max_length is not None]


@dataclass(frozen=True)
class ForeignKey:
    child: str
    column: str
    parent: str


def _text(name: str, length: int, required: bool = True) -> Column:
    return Column(name, T.StringType(), required, length)


# Names, types and limits of the source system.
SPECS = {
    spec.name: spec
    for spec in (
        TableSpec(
            MEMBER,
            (
                Column("id", T.IntegerType()),
                _text("nome", 100),
                _text("sobrenome", 100),
                Column("idade", T.IntegerType()),
                _text("email", 150),
                _text("cpf", 14),
            ),
            unique=("cpf",),
        ),
        TableSpec(
            ACCOUNT,
            (
                Column("id", T.IntegerType()),
                _text("tipo", 50),
                Column("data_criacao", T.TimestampNTZType()),
                Column("id_associado", T.IntegerType()),
            ),
        ),
        TableSpec(
            CARD,
            (
                Column("id", T.IntegerType()),
                _text("num_cartao", 20),
                _text("nom_impresso", 100),
                _text("bandeira", 20),
                Column("data_criacao", T.TimestampNTZType()),
                Column("id_conta", T.IntegerType()),
                Column("id_associado", T.IntegerType()),
            ),
        ),
        TableSpec(
            MOVEMENT,
            (
                Column("id", T.IntegerType()),
                Column("vlr_transacao", AMOUNT),
                _text("des_transacao", 200, required=False),
                Column("data_movimentacao", T.TimestampNTZType()),
                Column("id_cartao", T.IntegerType()),
            ),
        ),
        TableSpec(
            INTERACTION,
            (
                Column("associado_id", T.IntegerType(), False),
                Column("canal", T.StringType(), False),
                Column("tipo_interacao", T.StringType(), False),
                Column("mensagem", T.StringType(), False),
                Column("data_interacao", T.TimestampNTZType(), False),
                Column(
                    "metadata",
                    T.StructType(
                        [
                            T.StructField("dispositivo", T.StringType()),
                            T.StructField("satisfacao", T.IntegerType()),
                        ]
                    ),
                    False,
                ),
            ),
            primary_key=None,
        ),
    )
}

# Every reference points at the parent's "id". The last one is not declared by
# the source system but the flat view joins on it.
FOREIGN_KEYS = (
    ForeignKey(ACCOUNT, "id_associado", MEMBER),
    ForeignKey(CARD, "id_conta", ACCOUNT),
    ForeignKey(CARD, "id_associado", MEMBER),
    ForeignKey(MOVEMENT, "id_cartao", CARD),
    ForeignKey(INTERACTION, "associado_id", MEMBER),
)


@dataclass(frozen=True)
class Tables:
    """The five sources, wherever they were read from."""

    members: DataFrame
    accounts: DataFrame
    cards: DataFrame
    movements: DataFrame
    interactions: DataFrame

    def by_name(self) -> dict[str, DataFrame]:
        return {
            MEMBER: self.members,
            ACCOUNT: self.accounts,
            CARD: self.cards,
            MOVEMENT: self.movements,
            INTERACTION: self.interactions,
        }
