from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from samples import movements, two_members
from tallylake.operators import constraints, flat, interactions, profile, reload, star, validity
from tallylake.schema import BUSINESS_KEY, FOREIGN_KEYS, SPECS, Tables

# --- validity ------------------------------------------------------------------


def test_amounts_are_split_by_sign(spark):
    df = spark.createDataFrame(
        [(1, 8.5), (2, -1.0), (3, -0.01), (4, 0.01), (5, 20.0)], ["id", "vlr_transacao"]
    )
    sides = validity.split(df)
    assert {r.id for r in sides.valid.collect()} == {1, 4, 5}
    assert {r.id for r in sides.invalid.collect()} == {2, 3}
    assert sides.invalid_pct == 40.0


def test_nothing_to_split(spark):
    df = spark.createDataFrame([], "id int, vlr_transacao double")
    assert validity.split(df).invalid_pct == 0.0
    assert validity.summary(df).first().percentual_invalidas == 0.0


def test_zero_is_invalid_and_null_is_neither(spark):
    df = spark.createDataFrame(
        [(1, 0.0), (2, None), (3, 5.0)], "id int, vlr_transacao double"
    )
    row = validity.summary(df).first()
    assert (row.total_registros, row.validas, row.invalidas, row.sem_valor) == (3, 1, 1, 1)
    assert row.percentual_invalidas == 33.33
    assert validity.valid_rows(df).count() + validity.invalid_rows(df).count() == 2


def test_amount_column_can_be_named(spark):
    df = spark.createDataFrame([(1, -1.0)], "id int, valor double")
    assert validity.split(df, "valor").invalid_pct == 100.0


# --- profile -------------------------------------------------------------------


def test_null_share_per_column(spark):
    df = spark.createDataFrame([(n, "x" if n % 5 else None) for n in range(20)], "id int, valor string")
    for got in (profile.measure(df, ["id"], None), profile.null_counts(df)):
        shares = {r.coluna: r.percentual_nulos for r in got.null_profile().collect()}
        assert shares == {"id": 0.0, "valor": 20.0}


def test_copies_of_a_key(spark):
    df = spark.createDataFrame([(4, 1), (4, 2), (4, 1), (5, 1), (4, 1)], "id_cartao int, valor int")
    document = profile.measure(df, ["id_cartao", "valor"], None).document()
    figures = document["metricas_movimentacao_bruta"]
    assert figures["total_duplicados"] == 2
    assert figures["percentual_duplicados"] == 40.0
    assert profile.key_copies(df, ["id_cartao", "valor"]).duplicate_profile().first()[1] == 2


def test_nulls_in_a_key_are_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "x")], "id_cartao int, des string")
    assert profile.measure(df, ["id_cartao", "des"], None).counts.first().distinct_keys == 2
    assert profile.distinct_keys(df, ["id_cartao", "des"]).count() == 2


def test_profile_of_nothing(spark):
    df = spark.createDataFrame([], SPECS["movimentacao"].struct)
    document = profile.measure(df, BUSINESS_KEY).document()
    assert document["movimentacoes_invalidas_descartadas_pct"] == 0.0
    figures = document["metricas_movimentacao_bruta"]
    assert figures["total_registros"] == figures["total_duplicados"] == 0
    assert figures["percentual_duplicados"] == 0.0
    assert set(figures["percentual_nulos_por_coluna"].values()) == {0.0}
    assert list(figures["percentual_nulos_por_coluna"]) == df.columns


def test_profile_counts_validity_in_and_outside_the_key(spark):
    df = movements(
        spark,
        [
            (1, "5.00", None, "2024-01-01", 1),
            (2, "5.00", None, "2024-01-01", 1),
            (3, "0.00", "x", "2024-01-01", 1),
            (4, None, "x", None, 2),
        ],
    )
    for key in (BUSINESS_KEY, ("id_cartao",)):
        row = profile.measure(df, key).report().first()
        assert (row.total_registros, row.validas, row.invalidas, row.sem_valor) == (4, 2, 1, 1)
        assert row.percentual_nulos_por_coluna["des_transacao"] == 50.0
        assert row.percentual_nulos_por_coluna["data_movimentacao"] == 25.0
    assert profile.measure(df, BUSINESS_KEY).report().first().total_duplicados == 1
    assert profile.measure(df, ("id_cartao",)).report().first().total_duplicados == 2


def test_column_names_with_dots(spark):
    df = spark.createDataFrame([(1, None), (2, 3)], "`a.b` int, `c``d` int")
    rows = profile.measure(df, ["a.b"], None).null_profile().collect()
    assert [(r.coluna, r.nulos) for r in rows] == [("a.b", 0), ("c`d", 1)]


def test_unknown_key_is_refused(spark):
    df = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(ValueError):
        profile.measure(df, ["nope"])
    with pytest.raises(ValueError):
        profile.measure(df, [])


def test_percentages_in_the_document_round_like_python(spark):
    df = spark.createDataFrame([(i, -1.0 if i < 1 else 1.0) for i in range(800)], "id int, v double")
    document = profile.measure(df, ["id"], "v").document()
    assert document["movimentacoes_invalidas_descartadas_pct"] == round(1 / 800 * 100, 2) == 0.12


def test_worst_column_ties_go_to_the_first(spark):
    df = spark.createDataFrame([(1, None, None)], "a int, b int, c int")
    nulls = profile.null_counts(df).null_profile()
    assert profile.worst_column(nulls).first().coluna == "b"
    assert [r.coluna for r in profile.ranking(nulls).collect()] == ["b", "c", "a"]
    none = nulls.where("false")
    assert tuple(profile.worst_column(none).first()) == ("—", 0.0)
    assert profile.max_null_pct(none).first()[0] == 0.0


# --- flat view and star --------------------------------------------------------


def test_transaction_reaches_its_member(spark):
    rows = flat.build(two_members(spark)).collect()
    assert len(rows) == 3
    bread = {r.des_transacao_movimento: r for r in rows}["Padaria"]
    assert (bread.nome, bread.sobrenome, bread.cpf) == ("Ana", "P.", "***.***.**-44")
    assert (bread.bandeira_cartao, bread.tipo_conta) == ("Mastercard", "poupanca")
    assert bread.vlr_transacao_movimento == Decimal("45.00")
    assert bread.qtd_interacoes_historico == 3


def test_no_interactions_is_null_not_zero(spark):
    rows = flat.build(two_members(spark)).where("nome = 'Davi'").collect()
    assert [r.qtd_interacoes_historico for r in rows] == [None]


def test_published_form_and_back(spark):
    typed = flat.build(two_members(spark))
    text = flat.as_contract(typed)
    assert tuple(text.columns) == flat.COLUMNS
    assert {text.schema[c].dataType.simpleString() for c in flat.TEXT_COLUMNS} == {"string"}
    assert {r.vlr_transacao_movimento for r in text.collect()} == {"12.30", "45.00", "7.05"}
    back = flat.as_typed(text).select("vlr_transacao_movimento").collect()
    assert sorted(r[0] for r in back) == [Decimal("7.05"), Decimal("12.30"), Decimal("45.00")]


def test_member_is_the_cards_own(spark):
    t = two_members(spark)
    crossed = t.cards.withColumn("id_associado", F.when(F.col("id") == 701, 2).otherwise(1))
    rows = flat.build(Tables(t.members, t.accounts, crossed, t.movements, t.interactions))
    assert {(r.bandeira_cartao, r.nome, r.tipo_conta) for r in rows.collect()} == {
        ("Mastercard", "Davi", "poupanca"),
        ("Elo", "Ana", "corrente"),
    }


def test_copies_stay_in_flat_and_fact(spark):
    t = two_members(spark)
    doubled = Tables(
        t.members, t.accounts, t.cards, t.movements.unionByName(t.movements), t.interactions
    )
    assert flat.build(doubled).count() == 6
    assert star.build(doubled)["fato_movimentacao"].count() == 6


def test_star_has_four_tables(spark):
    tables = star.build(two_members(spark))
    assert set(tables) == {"dim_associado", "dim_conta", "dim_cartao", "fato_movimentacao"}


def test_member_dimension_is_masked_and_counted(spark):
    shown = star.build(two_members(spark))["dim_associado"].drop("idade_associado", "email")
    assert {tuple(r) for r in shown.collect()} == {
        (1, "Ana", "P.", "***.***.**-44", 3),
        (2, "Davi", "N.", "***.***.**-88", None),
    }


def test_fact_has_the_three_keys_and_one_row_per_transaction(spark):
    fact = star.build(two_members(spark))["fato_movimentacao"]
    assert {"id_cartao", "id_conta", "id_associado"} <= set(fact.columns)
    assert fact.count() == 3


def test_dimensions_do_not_grow(spark):
    tables = star.build(two_members(spark))
    assert {n: df.count() for n, df in tables.items() if n.startswith("dim_")} == {
        "dim_associado": 2,
        "dim_conta": 2,
        "dim_cartao": 2,
    }


def test_account_dimension_has_no_member(spark):
    assert star.build(two_members(spark))["dim_conta"].columns == [
        "id_conta",
        "tipo_conta",
        "data_criacao_conta",
    ]


def test_fact_keeps_what_flat_drops(spark):
    t = two_members(spark)
    lost = Tables(
        t.members.where("id = 1"), t.accounts.where("id = 32"), t.cards, t.movements, t.interactions
    )
    assert star.build(lost)["fato_movimentacao"].count() == 3
    assert flat.build(lost).count() == 0


def test_interactions_without_a_member_are_counted(spark):
    log = spark.createDataFrame([(1,), (None,), (None,)], "associado_id int")
    counts = {r.associado_id: r.qtd_interacoes for r in interactions.per_member(log).collect()}
    assert counts == {1: 1, None: 2}


# --- constraints ---------------------------------------------------------------


def _broken(spark):
    t = two_members(spark)
    return Tables(
        members=t.members.unionByName(t.members.where("id = 1")),
        accounts=t.accounts,
        cards=t.cards.withColumns(
            {
                "nom_impresso": F.repeat(F.lit("X"), 101),
                "id_associado": F.when(F.col("id") == 701, 2).otherwise(F.col("id_associado")),
                "id_conta": F.when(F.col("id") == 702, 99).otherwise(F.col("id_conta")),
            }
        ),
        movements=t.movements.withColumn(
            "vlr_transacao", F.when(F.col("id") != 9001, F.col("vlr_transacao"))
        ).withColumn("id_cartao", F.when(F.col("id") != 9002, F.col("id_cartao")).otherwise(7)),
        interactions=t.interactions,
    )


def test_every_constraint_reports_its_violations(spark):
    t = _broken(spark)
    keys = {(r.tabela, r.coluna): r for r in constraints.primary_keys(t).collect()}
    assert keys["associado", "id"].chaves_repetidas == 1
    assert keys["associado", "id"].linhas_excedentes == 1
    assert keys["conta", "id"].chaves_repetidas == 0
    assert constraints.unique_columns(t).first().chaves_repetidas == 1
    nulls = {(r.tabela, r.coluna): r.nulos for r in constraints.required_columns(t).collect()}
    assert nulls["movimentacao", "vlr_transacao"] == 1
    assert ("movimentacao", "des_transacao") not in nulls
    assert sum(nulls.values()) == 1
    orphans = {(r.tabela, r.coluna): r.orfas for r in constraints.foreign_keys(t).collect()}
    assert orphans["movimentacao", "id_cartao"] == 1
    assert orphans["cartao", "id_conta"] == 1
    assert sum(orphans.values()) == 2
    long = {(r.tabela, r.coluna): r.excedentes for r in constraints.text_lengths(t).collect()}
    assert long["cartao", "nom_impresso"] == 2
    assert sum(long.values()) == 2
    assert constraints.member_consistency(t).first().cartoes_divergentes == 1


def test_offending_rows(spark):
    t = _broken(spark)
    assert constraints.rows_with_repeated(t.members, "id").count() == 2
    assert constraints.rows_with_null(t.movements, "vlr_transacao").first().id == 9001
    assert constraints.rows_longer_than(t.cards, "nom_impresso", 100).count() == 2
    to_card = next(fk for fk in FOREIGN_KEYS if fk.column == "id_cartao")
    assert constraints.rows_without_parent(t, to_card).first().id == 9002
    assert constraints.cards_of_other_members(t).first().id_cartao == 701


def test_null_reference_is_no_orphan(spark):
    t = two_members(spark)
    unowned = t.movements.withColumn("id_cartao", F.lit(None).cast("int"))
    t = Tables(t.members, t.accounts, t.cards, unowned, t.interactions)
    assert {r.orfas for r in constraints.foreign_keys(t).collect()} == {0}


# --- reloads -------------------------------------------------------------------


def test_first_per_key_keeps_the_smallest_id(spark):
    df = movements(
        spark,
        [
            (3, "1.00", None, "d", 1),
            (2, "1.00", None, "d", 1),
            (9, "1.00", "x", "d", 1),
        ],
    )
    kept = reload.first_per_key(df, BUSINESS_KEY)
    assert kept.columns == df.columns
    assert {(r.id, r.des_transacao) for r in kept.collect()} == {(2, None), (9, "x")}


def test_upsert_twice_is_upsert_once(spark):
    target = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "id int, v int, x string")
    batch = spark.createDataFrame(
        [(2, 2, "c"), (2, 3, "d"), (3, 1, "e")], "id int, v int, x string"
    )
    once = reload.upsert(target, batch, ["id"], ["v"])
    twice = reload.upsert(once, batch, ["id"], ["v"])
    want = {(1, 1, "a"), (2, 3, "d"), (3, 1, "e")}
    assert {tuple(r) for r in once.collect()} == want
    assert sorted(tuple(r) for r in twice.collect()) == sorted(want)


def test_upsert_keeps_the_newer_row_of_the_target(spark):
    target = spark.createDataFrame([(1, 3, "new"), (2, 1, "old")], "id int, v int, x string")
    batch = spark.createDataFrame([(1, 1, "late"), (2, 1, "same")], "id int, v int, x string")
    loaded = reload.upsert(target, batch, ["id"], ["v"])
    assert {tuple(r) for r in loaded.collect()} == {(1, 3, "new"), (2, 1, "same")}


def test_bad_amount_fails(spark):
    row = dict.fromkeys(flat.COLUMNS, "1") | {"vlr_transacao_movimento": "12,30"}
    published = spark.createDataFrame([row]).select(*flat.COLUMNS)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        flat.as_typed(published.withColumn("data_movimentacao", F.lit("2024-01-01 00:00:00"))).collect()


def test_insert_new_leaves_the_target_alone(spark):
    target = spark.createDataFrame([(1, "a"), (1, "a")], "id int, x string")
    batch = spark.createDataFrame([(1, "z"), (2, "c"), (2, "b")], "id int, x string")
    out = sorted(tuple(r) for r in reload.insert_new(target, batch, ["id"]).collect())
    assert out == [(1, "a"), (1, "a"), (2, "b")]
