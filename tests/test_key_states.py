"""One mergeable state for all rules, against the rules taken one by one."""

from dataclasses import replace
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylake.operators import constraints, key_states
from tallylake.schema import SPECS, Tables
from testbed import fixtures

from samples import movements, two_members


def rule_by_rule(tables):
    """The same rows from the single checks, which read a table per rule and join."""

    def as_rule(df, rule, violations):
        return df.select(F.lit(rule).alias("regra"), "tabela", "coluna", F.col(violations).alias("violacoes"))

    frames = [
        as_rule(constraints.primary_keys(tables), "primary_key", "linhas_excedentes"),
        as_rule(constraints.unique_columns(tables), "unique", "linhas_excedentes"),
        as_rule(constraints.required_columns(tables), "not_null", "nulos"),
        as_rule(constraints.text_lengths(tables), "length", "excedentes"),
        as_rule(constraints.foreign_keys(tables), "foreign_key", "orfas"),
        constraints.member_consistency(tables).selectExpr(
            "'same_member' as regra", "'cartao' as tabela", "'id_associado' as coluna", "cartoes_divergentes as violacoes"
        ),
    ]
    return counted(reduce(DataFrame.unionByName, frames))


def counted(df):
    rows = df.collect()
    found = {(r.regra, r.tabela, r.coluna): r.violacoes for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.fixture(scope="module")
def broken(spark):
    """Every rule broken at least once: repeated, missing and unknown keys on either side, in text and numbers."""
    good = two_members(spark)
    return Tables(
        members=good.members.union(
            spark.createDataFrame(
                [(1, "Bia", None, 20, "b", "111.222.333-44"), (None, "Z" * 101, "Q", 1, "c", "9" * 15),
                 (3, "Caio", "R", None, None, "555.666.777-88"), (4, "D", "S", 1, "d", None)],
                good.members.schema,
            )
        ),
        accounts=good.accounts.union(
            spark.createDataFrame(
                [(31, "corrente", "2021-01-01", 2), (33, None, "2021-01-01", None), (None, "x", "2021-01-01", 1),
                 (34, "corrente", "2021-01-01", 77)],
                good.accounts.schema,
            )
        ),
        cards=good.cards.union(
            spark.createDataFrame(
                [(703, "1", "N" * 101, "Elo", "2021-01-01", 31, 2), (704, "2", "N", "Elo", "2021-01-01", 33, None),
                 (705, "3", "N", "Elo", "2021-01-01", 33, 1), (706, "4", "N", "Elo", "2021-01-01", 99, 98),
                 (706, "4", "N", "Elo", "2021-01-01", None, None), (None, "5", "N", None, "2021-01-01", 32, 2)],
                good.cards.schema,
            )
        ),
        movements=good.movements.union(
            movements(
                spark,
                [(9001, None, "again", "2023-02-10", 701), (9004, "1.00", "D" * 201, "2023-02-10", 1), (None, "1.00", None, None, None)]
                + [(9100 + k, "1.00", "hot and unknown", "2023-02-10", 2) for k in range(50)],
            )
        ),
        interactions=good.interactions.union(
            spark.createDataFrame([(55, "app", "d", "x", "2024-01-01", None), (None, "app", "d", "x", "2024-01-01", None)], good.interactions.schema)
        ),
    )


def test_same_counts_as_rule_by_rule(spark, broken):
    found = counted(constraints.summary(broken))
    assert found == rule_by_rule(broken)
    assert found["foreign_key", "movimentacao", "id_cartao"] == 51
    assert found["same_member", "cartao", "id_associado"] > 0
    assert sum(v > 0 for v in found.values()) >= 15


def test_keys_as_text(spark, broken):
    """Ids of mixed types compare as text, also where only the child's are."""
    as_text = replace(
        broken,
        accounts=broken.accounts.withColumn("id", F.concat(F.lit("a:="), "id")),
        cards=broken.cards.withColumns(
            {"id_conta": F.concat(F.lit("a:="), "id_conta"), "id_associado": F.col("id_associado").cast("string")}
        ),
        members=broken.members.withColumn("id", F.col("id").cast("bigint")),
    )
    assert counted(constraints.summary(as_text)) == counted(constraints.summary(broken))


def test_clean_and_empty_tables(spark):
    good = two_members(spark)
    assert set(counted(constraints.summary(good)).values()) == {0}
    nothing = Tables(*[df.limit(0) for df in good.by_name().values()])
    found = counted(constraints.summary(nothing))
    assert set(found.values()) == {0}
    assert len(found) == sum(len(s.required) + len(s.bounded) + len(s.unique) + bool(s.primary_key) for s in SPECS.values()) + 6


def test_states_of_loads_add_up(spark, broken, tmp_path):
    path = str(tmp_path / "states")
    first = F.col("id").isNull() | (F.col("id") % 2 == 0)
    halves = [
        replace(broken, movements=broken.movements.where(first)),
        Tables(*[df.limit(0) for df in broken.by_name().values()]),
    ]
    halves[1] = replace(halves[1], movements=broken.movements.where(~first))
    for name, half in zip(("a", "b", "b"), (halves[0], halves[1], halves[1])):
        key_states.record(key_states.state(half), name, path)  # the second load is repeated
    assert counted(key_states.verdicts(key_states.recorded(spark, path))) == rule_by_rule(broken)


def test_a_hot_key_is_one_row_of_the_state(spark, sf_dir):
    tables = fixtures.load(spark, sf_dir)
    hot = replace(tables, movements=tables.movements.withColumn("id_cartao", F.lit(1).cast("bigint")))
    log = hot.interactions.selectExpr("*", "'x' as tipo_interacao", "'x' as mensagem")
    states = key_states.state(replace(hot, interactions=log))
    space = key_states.SPACES.index(("key", "cartao", "id"))
    row = states.where((F.col("space") == space) & (F.col("number") == 1)).collect()
    assert len(row) == 1 and row[0].refs_1 == tables.movements.count()
