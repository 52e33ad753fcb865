"""Transactions in buckets, keyed pseudonyms, and cuts at quantiles of a key."""

import hashlib
import hmac
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tallylake.functions import pseudonyms
from tallylake.operators import flat
from tallylake.sources import bucketed, relational
from testbed import fixtures


def test_hot_card_is_kept_apart(spark, sf_dir, tmp_path):
    tables = fixtures.load(spark, sf_dir)
    some = tables.movements.select("id_cartao").first()[0]
    hot = F.when(F.pmod(F.xxhash64("id"), F.lit(3)) == 0, some).otherwise(F.col("id_cartao"))
    rows = tables.movements.withColumn("id_cartao", hot)
    rows = rows.unionByName(rows.limit(5).withColumn("id_cartao", F.lit(None).cast("bigint")))
    path = str(tmp_path / "m")
    bucketed.write(rows, path, "id_cartao", 16)
    table = bucketed.read(spark, path)
    assert [r.heavy_key for r in table.heavy_keys.collect()] == [some]
    assert table.heavy.select("id_cartao").distinct().collect() == [(some,)]
    assert sorted(map(str, table.rows.collect())) == sorted(map(str, rows.collect()))
    changed = flat.build_bucketed(table, tables)
    tables = type(tables)(tables.members, tables.accounts, tables.cards, rows, tables.interactions)
    want = flat.build(tables)
    assert changed.exceptAll(want).count() == want.exceptAll(changed).count() == 0


def test_buckets_of_another_session(spark, tmp_path):
    path = str(tmp_path / "b")
    rows = spark.range(200).selectExpr("id", "id % 20 as k", "decimal(id) / 3 as amount")
    for _ in range(2):  # writing again replaces
        bucketed.write(rows, path, "k", 4)
    spark.sql(f"DROP TABLE {bucketed._name(path)}")
    again = bucketed.read(spark, path)
    assert sorted(again.rows.collect()) == sorted(rows.collect())
    plan = again.light.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_pseudonyms_are_hmacs(spark):
    secret = b"sixteen bytes or more"
    values = ["111.222.333-44", "", None, "naïve 日本", "x" * 500]
    df = spark.createDataFrame([(i, v, v) for i, v in enumerate(values)], "id int, cpf string, email string")
    got = {r.id: r for r in pseudonyms.mask_keyed(df, secret).collect()}
    for i, value in enumerate(values):
        for kind in ("cpf", "email"):
            own = hashlib.sha256(kind.encode() + b"\0" + secret).digest()
            want = None if value is None else hmac.new(own, value.encode(), "sha256").hexdigest()
            assert got[i][kind] == want
    assert got[0].cpf != got[0].email


def test_pseudonyms_join_and_need_a_secret(spark, confs):
    cards = spark.createDataFrame([("4000", "a"), ("5000", "b")], "num_cartao string, x string")
    view = spark.createDataFrame([("4000", 1), ("9999", 2)], "numero_cartao string, y int")
    with pytest.raises(ValueError, match="pseudonymSecret"):
        pseudonyms.mask_keyed(cards)
    confs(spark__tallylake__pseudonymSecret="short")
    with pytest.raises(ValueError, match="16 bytes"):
        pseudonyms.mask_keyed(cards)
    confs(spark__tallylake__pseudonymSecret="long enough, this one is")
    left, right = pseudonyms.mask_keyed(cards), pseudonyms.mask_keyed(view)
    assert left.join(right, left.num_cartao == right.numero_cartao).select("x", "y").collect() == [("a", 1)]
    shown = left._jdf.queryExecution().toString()
    own = hashlib.sha256(b"cartao\0long enough, this one is").digest()
    for pad in (0x36, 0x5C):
        assert bytes(b ^ pad for b in own).hex().upper()[:32] not in shown.upper()


@pytest.mark.parametrize("kind", ["gap", "crowded", "text", "few", "none"])
def test_cuts_at_quantiles(kind):
    rng = random.Random(1)
    keys = {
        "gap": [*range(500), *range(10**9, 10**9 + 500)],
        "crowded": [min(int(rng.expovariate(0.001)), 5000) for _ in range(1000)],
        "text": [f"o'key {rng.randrange(10**6):06d}" for _ in range(1000)],
        "few": [7] * 900 + [8] * 100,
        "none": [],
    }[kind]
    db = duckdb.connect()
    db.execute(f"CREATE TABLE t (id {'VARCHAR' if kind == 'text' else 'BIGINT'}, row_no BIGINT)")
    rows = [(k, i) for i, k in enumerate([*keys, None, None])]
    db.executemany("INSERT INTO t VALUES (?, ?)", rows)
    cuts = db.execute(f"SELECT cut FROM {relational.quantile_query('t', 8, 'id')}").fetchall()
    parts = relational.KeyCuts("id", tuple(c for (c,) in cuts)).predicates()
    found = [db.execute(f"SELECT row_no FROM t WHERE {p}").fetchall() for p in parts]
    assert sorted(r for part in found for (r,) in part) == list(range(len(rows)))
    if kind in ("gap", "crowded", "text"):
        assert len(parts) == 8 and max(map(len, found)) <= 2 * len(rows) / 8


def test_quantiles_of_a_sample():
    query = relational.quantile_query("movimentacao", 100, "id", 0.5)
    assert "TABLESAMPLE SYSTEM (0.5)" in query and "ntile(100)" in query
