"""The given tables read as members, accounts, cards, transactions and interactions.

The given tables are clean, so known defects are put in by rules over their
keys; the SQL oracles state the same rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylake.operators import defects
from tallylake.schema import AMOUNT, Tables

METADATA = T.StructType([T.StructField("k", T.IntegerType())])


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    digits = F.lpad(key.cast("string"), 11, "0")
    return _table(spark, sf_dir, "customer").select(
        key.alias("id"),
        F.substring("c_name", 1, 8).alias("nome"),
        F.col("c_mktsegment").alias("sobrenome"),
        (key % 63 + 18).cast("int").alias("idade"),
        F.concat(F.lower("c_mktsegment"), key.cast("string"), F.lit("@x.test")).alias("email"),
        F.concat_ws(
            "-",
            F.concat_ws(
                ".",
                F.substring(digits, 1, 3),
                F.substring(digits, 4, 3),
                F.substring(digits, 7, 3),
            ),
            F.substring(digits, 10, 2),
        ).alias("cpf"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_nationkey") % 2 == 0, "corrente").otherwise("poupanca").alias("tipo"),
        F.lit("2020-01-01 00:00:00").cast("timestamp_ntz").alias("data_criacao"),
        F.col("c_custkey").alias("id_associado"),
    )


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    return _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.lpad(key, 16, "4").alias("num_cartao"),
        F.concat(F.lit("CARD "), key).alias("nom_impresso"),
        F.col("o_orderpriority").alias("bandeira"),
        F.col("o_orderdate").alias("data_criacao"),
        F.col("o_custkey").alias("id_conta"),
        F.col("o_custkey").alias("id_associado"),
    )


def _raw_movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean transactions, still with the two keys the defect rules look at."""
    return _table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("id"),
        F.col("l_extendedprice").cast(AMOUNT).alias("vlr_transacao"),
        F.col("l_returnflag").alias("des_transacao"),
        F.col("l_shipdate").alias("data_movimentacao"),
        F.col("l_orderkey").alias("id_cartao"),
        "l_partkey",
        "l_suppkey",
    )


def movements(spark: SparkSession, sf_dir: str, with_copies: bool = True) -> DataFrame:
    part, supplier = F.col("l_partkey"), F.col("l_suppkey")
    return defects.inject(
        _raw_movements(spark, sf_dir),
        negative=part % 25 == 0,
        missing=part % 97 == 3,
        undescribed=supplier % 14 == 0,
        copied=(part % 50 == 1) if with_copies else F.lit(False),
        copy_id=F.concat("id", F.lit("-d")),
    ).drop("l_partkey", "l_suppkey")


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select(
        F.col("user_id").alias("associado_id"),
        F.col("event_type").alias("canal"),
        F.col("ts").alias("data_interacao"),
        F.from_json("props", METADATA).alias("metadata"),
    )


def load(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(
        members=members(spark, sf_dir),
        accounts=accounts(spark, sf_dir),
        cards=cards(spark, sf_dir),
        movements=movements(spark, sf_dir),
        interactions=interactions(spark, sf_dir),
    )


def load_broken(spark: SparkSession, sf_dir: str) -> Tables:
    """The same tables with rows that break every constraint."""
    key = F.col("id")
    bad_members = members(spark, sf_dir).withColumn(
        "cpf",
        F.when(key % 40 == 8, F.concat(F.lit("dup-"), (key % 3).cast("string"))).otherwise(
            F.col("cpf")
        ),
    )
    bad_cards = cards(spark, sf_dir).withColumns(
        {
            "nom_impresso": F.when(key % 200 == 0, F.repeat(F.lit("X"), 120)).otherwise(
                F.col("nom_impresso")
            ),
            "id_conta": F.when(key % 333 == 0, -1).otherwise(F.col("id_conta")),
            "id_associado": F.when(key % 150 == 0, (F.col("id_associado") + 1) % 100).otherwise(
                F.col("id_associado")
            ),
        }
    )
    card = F.col("id_cartao")
    twice = F.when(card % 500 == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    bad_movements = (
        movements(spark, sf_dir, with_copies=False)
        .withColumn("again", F.explode(twice))
        .withColumn(
            "id_cartao", F.when((card % 101 == 5) & (F.col("again") == 0), -1).otherwise(card)
        )
        .drop("again")
    )
    log = _table(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 97 == 0, -1).otherwise(F.col("user_id")).alias("associado_id"),
        F.col("event_type").alias("canal"),
        F.col("ts").alias("data_interacao"),
    )
    return Tables(bad_members, accounts(spark, sf_dir), bad_cards, bad_movements, log)
