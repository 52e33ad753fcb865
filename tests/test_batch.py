import csv
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from samples import two_members
from tallylake.operators import flat, profile, snowflake
from tallylake.plans import batch, history, manifest, marts, report
from tallylake.schema import BUSINESS_KEY, Tables
from tallylake.sources import files, storage
from tallylake.workspace import session_folder
from testbed import fixtures


@pytest.fixture(scope="module")
def outcome(spark, sf_dir, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("run"))
    return batch.run(fixtures.load(spark, sf_dir), out, run_id="2024-01-01")


def test_report_document(outcome):
    with open(outcome.layout.report, encoding="utf-8") as f:
        assert json.load(f) == outcome.report
    assert outcome.report == {
        "movimentacoes_invalidas_descartadas_pct": 3.47,
        "metricas_movimentacao_bruta": {
            "total_registros": 6111,
            "percentual_nulos_por_coluna": {
                "id": 0.0,
                "vlr_transacao": 1.51,
                "des_transacao": 9.0,
                "data_movimentacao": 0.0,
                "id_cartao": 0.0,
            },
            "percentual_duplicados": 1.82,
            "total_duplicados": 111,
        },
    }


def test_brands_are_exported_in_order(outcome):
    rows = []
    for part in sorted(Path(outcome.layout.brand_csv).glob("part-*")):
        with open(part, newline="", encoding="utf-8") as f:
            rows += [tuple(r.values()) for r in csv.DictReader(f)]
    assert [(b, int(n), float(v)) for b, n, v in rows] == [
        ("2-HIGH", 1215, 63917621.12),
        ("3-MEDIUM", 1208, 62229021.64),
        ("5-LOW", 1159, 61474160.25),
        ("1-URGENT", 1118, 59387249.25),
        ("4-NOT SPECIFIED", 1107, 59385624.89),
    ]


def test_mart_query_is_ordered(spark, sf_dir):
    brands = [r.bandeira_cartao for r in marts.brand_mart(fixtures.load(spark, sf_dir)).collect()]
    assert brands == ["2-HIGH", "3-MEDIUM", "5-LOW", "1-URGENT", "4-NOT SPECIFIED"]


def test_flat_outputs(spark, outcome):
    published = spark.read.parquet(outcome.layout.flat_parquet)
    assert outcome.flat_rows == published.count() == 5807
    assert tuple(published.columns) == flat.COLUMNS
    text = files.read_csv(spark, outcome.layout.flat_csv)
    as_text = published.select([F.col(c).cast("string") for c in published.columns])
    assert text.exceptAll(as_text).count() == 0
    assert as_text.exceptAll(text).count() == 0


def test_star_outputs(spark, outcome):
    counts = {
        name: spark.read.parquet(outcome.layout.star(name)).count()
        for name in ("dim_associado", "dim_conta", "dim_cartao", "fato_movimentacao")
    }
    assert counts == {
        "dim_associado": 150,
        "dim_conta": 150,
        "dim_cartao": 1500,
        "fato_movimentacao": 5807,
    }
    fact = spark.read.parquet(outcome.layout.star("fato_movimentacao"))
    assert dict(fact.dtypes)["vlr_transacao"] == "decimal(15,2)"
    assert dict(fact.dtypes)["data_movimentacao"] == "timestamp_ntz"
    assert float(fact.agg(F.sum("vlr_transacao")).first()[0]) == 306393677.15


def test_dashboard_tables(spark, outcome):
    tables = batch.dashboards(spark, outcome.layout.output)
    kpi = tables["kpi_summary"].first()
    assert (kpi.total_registros, kpi.valor_total) == (5807, 306393677.15)
    assert (kpi.associados_distintos, kpi.cartoes_distintos) == (150, 1370)
    assert kpi.ticket_medio == pytest.approx(52762.81679869123, rel=1e-15)
    labels = tables["kpi_labels"].first()
    assert (labels.total_registros, labels.valor_total) == ("5,807", "R$ 306.393.677,15")
    assert labels.ticket_medio == "R$ 52.762,82"
    headline = tables["quality_headline"].first()
    assert (headline.pior_coluna, headline.percentual_pior_coluna) == ("des_transacao", 9.0)
    assert (headline.severidade_invalidas, headline.severidade_duplicados) == ("OK", "OK")
    ranked = [(r.coluna, r.severidade) for r in tables["null_ranking"].collect()]
    assert ranked == [
        ("des_transacao", "ATENÇÃO"),
        ("vlr_transacao", "OK"),
        ("id", "OK"),
        ("data_movimentacao", "OK"),
        ("id_cartao", "OK"),
    ]
    bars = {r.indicador: r.largura for r in tables["quality_bars"].collect()}
    assert bars["maior_percentual_nulos"] == 36.0
    moments = [r.data_movimentacao for r in tables["sample_rows"].collect()]
    assert len(moments) == 8 and moments == sorted(moments, reverse=True)


def test_dashboards_need_a_finished_run(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no finished run"):
        batch.dashboards(spark, str(tmp_path))


def test_rerun_replaces_everything(spark, tmp_path):
    out = str(tmp_path / "out")
    full = two_members(spark)
    batch.run(full, out, run_id="r1")
    less = Tables(
        full.members, full.accounts, full.cards, full.movements.where("id = 9001"), full.interactions
    )
    again = batch.run(less, out, run_id="r1")
    assert again.flat_rows == 1
    assert spark.read.parquet(again.layout.star("fato_movimentacao")).count() == 1
    totals = history.read(spark, again.layout.history).where("metrica = 'total_registros'")
    assert [r.valor for r in totals.collect()] == [1.0]


def test_empty_sources(spark, tmp_path):
    full = two_members(spark)
    none = Tables(*[df.where("false") for df in full.by_name().values()])
    done = batch.run(none, str(tmp_path / "out"))
    assert done.flat_rows == 0
    assert done.report["movimentacoes_invalidas_descartadas_pct"] == 0.0
    kpi = marts.kpi_summary(none).first()
    assert tuple(kpi) == (0, 0.0, 0.0, 0, 0)
    assert marts.sample_rows(flat.build(none)).count() == 0
    assert snowflake.build(none)["dim_tempo"].count() == 0


def test_both_routes_to_the_marts_agree(spark, sf_dir):
    t = fixtures.load_broken(spark, sf_dir)
    view = flat.build(t)
    assert marts.brand_mart(t).collect() == marts.brand_mart_of(view).collect()
    assert marts.kpi_summary(t).collect() == marts.kpi_summary_of(flat.as_contract(view)).collect()
    shown = marts.sample_rows(view).collect()
    published = marts.sample_rows(flat.as_contract(view)).collect()
    assert [[str(v) for v in r] for r in shown] == [[str(v) for v in r] for r in published]


def test_sample_without_moments_comes_last(spark):
    t = two_members(spark)
    undated = t.movements.withColumn(
        "data_movimentacao", F.when(F.col("id") != 9003, F.col("data_movimentacao"))
    )
    view = flat.build(Tables(t.members, t.accounts, t.cards, undated, t.interactions))
    rows = marts.sample_rows(view).collect()
    assert [r.nome for r in rows] == ["Ana", "Ana", "Davi"]
    assert len(marts.sample_rows(view, 2).collect()) == 2


def test_kpis_count_missing_values_once_and_average_over_all_rows(spark):
    view = spark.createDataFrame(
        [(1, "a", "x", "10.00"), (1, None, "x", None), (None, None, "y", "5.00")],
        "id_associado int, numero_cartao string, bandeira_cartao string, vlr_transacao_movimento string",
    )
    kpi = marts.kpi_summary_of(view).first()
    assert (kpi.total_registros, kpi.valor_total, kpi.ticket_medio) == (3, 15.0, 5.0)
    assert (kpi.associados_distintos, kpi.cartoes_distintos) == (2, 2)


def test_brands_with_equal_totals_are_in_name_order(spark):
    view = spark.createDataFrame(
        [("b", "1.00"), ("a", "1.00"), ("c", "2.00")],
        "bandeira_cartao string, vlr_transacao_movimento string",
    )
    assert [r.bandeira_cartao for r in marts.brand_mart_of(view).collect()] == ["c", "a", "b"]


def test_report_tables_of_an_empty_report(spark, tmp_path):
    path = str(tmp_path / "r.json")
    storage.write_document(spark, {}, path)
    row = files.read_report(spark, path)
    headline = report.quality_headline(row).first()
    assert (headline.pior_coluna, headline.percentual_pior_coluna) == ("—", 0.0)
    assert report.null_ranking(row).count() == 0
    assert {r.largura for r in report.quality_bars(row).collect()} == {0.0}
    assert report.null_series(row).first().rotulos == "[]"


def test_chart_arrays_share_one_order(spark, sf_dir):
    measured = profile.measure(fixtures.movements(spark, sf_dir), BUSINESS_KEY).report()
    series = report.null_series(measured).first()
    assert json.loads(series.rotulos)[:2] == ["des_transacao", "vlr_transacao"]
    assert json.loads(series.valores)[:3] == [9.0, 1.51, 0.0]
    assert json.loads(series.cores)[:2] == ["#B8862C", "#1F4D3A"]


def test_chart_has_a_row_per_brand_however_many(spark, sf_dir):
    mart = spark.range(1500).selectExpr(
        "cast(id as string) as bandeira_cartao", "id as qtd_movimentacoes", "1.0D as valor_total"
    )
    assert report.brand_points(mart).count() == 1500


def test_share_is_the_same_in_report_document_and_history(spark, tmp_path):
    rows = spark.range(800).selectExpr(
        "id", "id as id_cartao", "cast(if(id = 0, -1, 1) as decimal(15,2)) as vlr_transacao",
        "'x' as des_transacao", "timestamp_ntz '2024-01-01 00:00:00' as data_movimentacao",
    )
    measured = profile.measure(rows, BUSINESS_KEY)
    share = "movimentacoes_invalidas_descartadas_pct"
    assert measured.report().first()[share] == measured.document()[share] == 0.12
    path = str(tmp_path / "r.json")
    storage.write_document(spark, measured.document(), path)
    history.record(files.read_report(spark, path), "a", str(tmp_path / "h"))
    stored = history.read(spark, str(tmp_path / "h")).where(F.col("metrica") == share)
    assert stored.first().valor == 0.12


def test_history_keeps_other_runs(spark, tmp_path):
    path = str(tmp_path / "h")
    measured = profile.measure(two_members(spark).movements, BUSINESS_KEY).report()
    for run_id in ("a", "b", "a"):
        history.record(measured, run_id, path)
    counts = {r.run_id: r["count"] for r in history.read(spark, path).groupBy("run_id").count().collect()}
    assert counts == {"a": 9, "b": 9}


def test_strict_run_publishes_nothing_in_clear(spark, tmp_path):
    t = two_members(spark)
    outcome = batch.run(t, str(tmp_path / "out"), strict=True, with_snowflake=True, run_id="a")
    batch.write_dashboards(spark, outcome.layout.output)
    secrets = {r.email for r in t.members.collect()}
    secrets |= {x for r in t.cards.collect() for x in (r.num_cartao, r.nom_impresso)}
    published = 0
    for path in (tmp_path / "out").rglob("*.parquet"):
        if path.is_dir():
            continue
        for row in spark.read.parquet(str(path)).collect():
            published += 1
            assert not secrets & {str(v) for v in row.asDict().values()}
    text = "".join(p.read_text() for p in (tmp_path / "out").rglob("part-*.csv"))
    assert published and not any(secret in text for secret in secrets)


def test_single_brand_file_on_request(spark, tmp_path):
    outcome = batch.run(
        two_members(spark), str(tmp_path / "out"), single_csv=True, check_rules=False, with_csv=False
    )
    assert Path(outcome.layout.brand_csv).is_file()


def test_many_brands_pass_through_the_batch(spark, tmp_path):
    t = two_members(spark)
    n = 1_100
    cards = spark.range(1, n + 1).selectExpr(
        "cast(id as int) as id", "cast(id as string) as num_cartao", "'X' as nom_impresso",
        "concat('brand ', id) as bandeira", "timestamp_ntz '2024-01-01 00:00:00' as data_criacao",
        "cast(1 as int) as id_conta", "cast(1 as int) as id_associado",
    )
    one = t.accounts.limit(1)
    account = one.select(*[F.lit(1).cast("int").alias(c) if c in ("id", "id_associado") else c for c in one.columns])
    member = t.members.limit(1).withColumn("id", F.lit(1).cast("int"))
    moves = spark.range(1, n + 1).selectExpr(
        "cast(id as int) as id", "cast(1 as decimal(15,2)) as vlr_transacao", "'x' as des_transacao",
        "timestamp_ntz '2024-01-01 00:00:00' as data_movimentacao", "cast(id as int) as id_cartao",
    )
    tables = Tables(member, account, cards, moves, t.interactions)
    outcome = batch.run(tables, str(tmp_path / "out"), check_rules=False)
    assert outcome.flat_rows == n
    points = batch.dashboards(spark, outcome.layout.output)["chart_points"]
    assert points.where("grafico = 'bandeiras'").count() == n


def test_wide_table_is_removed_after_the_run(spark, tmp_path):
    batch.run(two_members(spark), str(tmp_path / "out"), check_rules=False, with_csv=False)
    left = Path(session_folder(spark).removeprefix("file:"))
    assert not list(left.glob("movements-wide-*"))


def test_a_run_cut_short_leaves_the_one_before_readable(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    full = two_members(spark)
    first = batch.run(full, out, run_id="a")
    shown = sorted(map(str, batch.dashboards(spark, out)["sample_rows"].collect()))
    less = Tables(
        full.members, full.accounts, full.cards, full.movements.where("id = 9001"), full.interactions
    )

    def killed(*args, **options):
        raise RuntimeError("executor lost for good")

    for step in ("write_by_month", "write_csv", "write_csv_ordered", "write_document"):
        with monkeypatch.context() as patch:
            patch.setattr(storage, step, killed)
            with pytest.raises(RuntimeError, match="lost for good"):
                batch.run(less, out)
        assert batch.published(spark, out) == first.layout
        assert sorted(map(str, batch.dashboards(spark, out)["sample_rows"].collect())) == shown
    last = batch.run(less, out)
    assert batch.published(spark, out) == last.layout
    assert batch.dashboards(spark, out)["kpi_summary"].first().total_registros == 1


def test_older_runs_go(spark, tmp_path):
    out = str(tmp_path / "out")
    for k in range(4):
        run = f"{out}/runs/r{k}"
        spark.range(k).write.parquet(f"{run}/t")
        assert manifest.publish(spark, out, run) == k
        assert manifest.current(spark, out) == run
    assert sorted(storage.names(spark, f"{out}/runs")) == ["r2", "r3"]
    with pytest.raises(FileExistsError):
        storage.write_once(spark, "{}", f"{out}/manifests/{3:012d}")


def test_rows_are_counted_while_written(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "timestampadd(DAY, id, timestamp'2024-01-01') as at")
    counts = {"rows": F.count(F.lit(1)), "even": F.count_if(F.col("id") % 2 == 0)}
    assert storage.write_by_month(rows, str(tmp_path / "a"), "at", counts=counts) == {"rows": 1000, "even": 500}
    none = rows.where("id < 0")
    assert storage.write_by_month(none, str(tmp_path / "b"), "at", counts=counts) == {"rows": 0, "even": 0}


def test_the_batch_runs_no_counting_job(spark, tmp_path, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    def counted(self):
        raise AssertionError("count() is a scan of its own")

    monkeypatch.setattr(DataFrame, "count", counted)
    done = batch.run(two_members(spark), str(tmp_path / "out"), with_csv=False)
    lost = {r.tabela: r.linhas for r in spark.read.parquet(done.layout.dropped).collect()}
    assert done.flat_rows == 3 and lost == {"fato_movimentacao": 3, "movimento_flat": 3}


def _shuffle_files(spark):
    dirs = spark._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    return {p.name for d in dirs for p in Path(d).rglob("shuffle_*")}


def _odd_tables(spark):
    """Forty cards: some twice, some without account, member or id; a member twice, and one who holds half the cards."""
    t = two_members(spark)
    member = spark.range(1, 9).selectExpr(
        "cast(if(id = 8, 7, id) as int) as id", "concat('N', id) as nome", "'Sobrenome' as sobrenome",
        "cast(30 as int) as idade", "'a@b.test' as email", "concat('111.222.333-0', id) as cpf",
    )
    account = spark.range(1, 7).selectExpr(
        "cast(id as int) as id", "if(id % 2 = 0, 'corrente', 'poupanca') as tipo",
        "timestamp_ntz '2020-01-01 00:00:00' as data_criacao", "cast(id as int) as id_associado",
    )
    card = spark.range(42).selectExpr(
        "cast(if(id = 41, null, if(id = 40, 3, id)) as int) as id", "concat('44', id) as num_cartao",
        "'X' as nom_impresso", "if(id % 3 = 0, 'Elo', 'Visa') as bandeira",
        "timestamp_ntz '2020-01-02 00:00:00' as data_criacao",
        "cast(if(id % 11 = 0, null, id % 8) as int) as id_conta",
        "cast(if(id % 2 = 0, 1, id % 9) as int) as id_associado",
    )
    move = spark.range(600).selectExpr(
        "cast(id as int) as id", "cast(if(id % 50 = 0, -1, id + 1) as decimal(15,2)) as vlr_transacao",
        "'d' as des_transacao",
        "if(id % 60 = 1, null, timestampadd(DAY, id % 90, timestamp_ntz '2024-01-01 00:00:00')) as data_movimentacao",
        "cast(if(id % 70 = 3, null, if(id % 4 = 0, 5, id % 45)) as int) as id_cartao",
    )
    return Tables(member, account, card, move, t.interactions)


def _published(spark, layout):
    tables = [batch.read_fact(spark, layout.star("fato_movimentacao")), spark.read.parquet(layout.flat_parquet)]
    return [sorted(map(str, table.collect())) for table in tables]


def test_rounds_write_the_rows_of_one_join(spark, tmp_path, monkeypatch):
    t = _odd_tables(spark)
    whole = batch.run(t, str(tmp_path / "whole"), with_csv=False)
    write, at_once = storage.write_by_month, []

    def watched(df, *args, **options):
        left = Path(session_folder(spark).removeprefix("file:"))
        at_once.append((len(list(left.glob("movements-wide-*"))), df.count()))
        return write(df, *args, **options)

    monkeypatch.setattr(batch, "ROUNDS_FROM", 1)
    monkeypatch.setattr(storage, "write_by_month", watched)
    parts = batch.run(t, str(tmp_path / "parts"), with_csv=False)
    fact, view = _published(spark, parts.layout)
    assert [fact, view] == _published(spark, whole.layout)
    assert parts.flat_rows == whole.flat_rows == len(view) < len(fact)
    for name in ("dropped", "rules", "brand_parquet"):
        one, other = (spark.read.parquet(getattr(o.layout, name)).collect() for o in (whole, parts))
        assert sorted(map(str, one)) == sorted(map(str, other))
    # the joined rows of one round at a time, and only a share of all
    assert [tables for tables, _ in at_once] == [1] * batch.ROUNDS
    assert sum(rows for _, rows in at_once) == len(fact)
    assert max(rows for _, rows in at_once) < 0.75 * len(fact)


def test_the_batch_leaves_no_shuffle_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(batch, "ROUNDS_FROM", 1)
    before = _shuffle_files(spark)
    batch.run(_odd_tables(spark), str(tmp_path / "out"), run_id="a")
    assert not _shuffle_files(spark) - before


def test_dashboards_leave_no_shuffle_files(spark, tmp_path):
    done = batch.run(two_members(spark), str(tmp_path / "out"), check_rules=False, with_csv=False)
    before = _shuffle_files(spark)
    assert batch.write_dashboards(spark, done.layout.output)
    assert not _shuffle_files(spark) - before


def test_few_rows_and_keys_of_two_types_are_joined_in_one_round(spark):
    t = two_members(spark)
    assert batch._rounds(t, batch.ROUNDS_FROM) == batch.ROUNDS
    assert batch._rounds(t, batch.ROUNDS_FROM - 1) == 1
    wider = t.cards.withColumn("id", F.col("id").cast("decimal(12,1)"))
    assert batch._rounds(Tables(t.members, t.accounts, wider, t.movements, t.interactions), 10**9) == 1
