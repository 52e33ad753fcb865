"""Small hand-made tables."""

from tallylake.schema import Tables

MEMBER = "id int, nome string, sobrenome string, idade int, email string, cpf string"
ACCOUNT = "id int, tipo string, data_criacao string, id_associado int"
CARD = (
    "id int, num_cartao string, nom_impresso string, bandeira string, data_criacao string, "
    "id_conta int, id_associado int"
)
MOVEMENT = (
    "id int, vlr_transacao decimal(15,2), des_transacao string, data_movimentacao string, "
    "id_cartao int"
)
LOG = (
    "associado_id int, canal string, tipo_interacao string, mensagem string, "
    "data_interacao string, metadata struct<dispositivo:string,satisfacao:int>"
)


def movements(spark, rows):
    from decimal import Decimal

    exact = [(i, None if v is None else Decimal(v), d, t, c) for i, v, d, t, c in rows]
    return spark.createDataFrame(exact, MOVEMENT)


def two_members(spark) -> Tables:
    """Ana has three interactions and two transactions, Davi one transaction."""
    return Tables(
        members=spark.createDataFrame(
            [
                (1, "Ana", "Prado", 52, "ana@mail.test", "111.222.333-44"),
                (2, "Davi", "Nunes", 27, "davi@mail.test", "555.666.777-88"),
            ],
            MEMBER,
        ),
        accounts=spark.createDataFrame(
            [(31, "poupanca", "2021-06-30 08:15:00", 1), (32, "corrente", "2022-11-05 17:40:00", 2)],
            ACCOUNT,
        ),
        cards=spark.createDataFrame(
            [
                (701, "4000100020003000", "ANA PRADO", "Mastercard", "2021-07-01 00:00:00", 31, 1),
                (702, "5000600070008000", "DAVI NUNES", "Elo", "2022-12-01 00:00:00", 32, 2),
            ],
            CARD,
        ),
        movements=movements(
            spark,
            [
                (9001, "12.30", "Livraria", "2023-02-10 10:11:12", 701),
                (9002, "45.00", "Padaria", "2023-02-11 06:30:00", 701),
                (9003, "7.05", "Estacionamento", "2023-02-12 20:00:01", 702),
            ],
        ),
        interactions=spark.createDataFrame(
            [(1, c, "duvida", "x", "2024-01-01 00:00:00", ("web", 3)) for c in ("app", "email", "app")],
            LOG,
        ),
    )
