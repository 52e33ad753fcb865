import re

import pytest
from pyspark.sql import functions as F

from tallylake.operators import flat, reload, star
from tallylake.operators.skew import balanced_join, heavy_keys, rows_with_key_in
from testbed import fixtures


@pytest.fixture(scope="module")
def lopsided(spark):
    """3,000 rows: one key holds a third, another a sixth, the rest are spread thin."""
    return spark.range(3000).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 3 == 0, 1)
        .when(F.col("id") % 6 == 1, 2)
        .otherwise(F.col("id"))
        .alias("k"),
    )


def test_only_heavy_keys_are_listed(spark, lopsided):
    listed = {r.heavy_key: r.pieces for r in heavy_keys(lopsided, "k", 10).collect()}
    assert listed == {1: 4, 2: 2}
    assert heavy_keys(lopsided, "k", 2).count() == 0


def test_list_of_heavy_keys_is_bounded(spark):
    even = spark.range(4000).select((F.col("id") % 20).alias("k"))
    assert heavy_keys(even, "k", 8).count() == 0
    assert heavy_keys(even, "k", 100).count() <= 100


def test_no_rows_no_heavy_keys(spark):
    assert heavy_keys(spark.range(0).withColumnRenamed("id", "k"), "k").count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("partitions", [1, 50, 1_000])
def test_same_rows_as_a_plain_join(spark, lopsided, partitions, how):
    right = spark.range(0, 3000, 2).select(F.col("id").alias("rk"), (F.col("id") * 10).alias("x"))
    right = right.unionByName(spark.createDataFrame([(1, -1), (1, -2), (None, 0)], "rk bigint, x bigint"))
    left = lopsided.unionByName(spark.createDataFrame([(-1, None)], "row bigint, k bigint"))
    plain = left.join(right, F.col("k") == F.col("rk"), how)
    spread = balanced_join(left, right, "k", "rk", F.col("row"), how, partitions)
    assert spread.columns == plain.columns
    want = sorted(map(str, plain.collect()))
    assert sorted(map(str, spread.collect())) == want
    assert len(want) > 2500


def test_heavy_key_is_spread_over_tasks(spark, lopsided, confs):
    confs(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    right = spark.createDataFrame([(1, "a")], "rk bigint, x string")
    joined = balanced_join(lopsided, right, "k", "rk", F.col("row"), "inner", 30)
    per_task = joined.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per_task) == 1000
    assert len(per_task) > 3
    assert max(r["count"] for r in per_task) < 600


@pytest.mark.parametrize("partitions", [1, 4, 1_000])
def test_rows_of_listed_keys(spark, lopsided, partitions):
    counts = lopsided.groupBy(F.col("k").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    repeated = counts.where("n > 1")
    got = rows_with_key_in(lopsided, "k", repeated, partitions)
    want = {r.row for r in lopsided.collect() if r.k in (1, 2)}
    assert sorted(r.row for r in got.collect()) == sorted(want)


def _hot_tables(spark, sf_dir):
    """One card holds more than a third of the transactions, one member a third of the cards."""
    t = fixtures.load(spark, sf_dir)
    row = F.xxhash64("id")
    hot = t.movements.withColumn(
        "id_cartao", F.when(F.pmod(row, F.lit(5)) < 2, F.lit(7)).otherwise(F.col("id_cartao"))
    )
    cards = t.cards.withColumn(
        "id_associado", F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id_associado"))
    )
    return type(t)(t.members, t.accounts, cards, hot, t.interactions)


def test_hot_card_partition_is_split_by_aqe(spark, sf_dir, confs, tmp_path):
    t = _hot_tables(spark, sf_dir)
    t.movements.repartition(8).write.parquet(str(tmp_path / "mov"))
    hot = spark.read.parquet(str(tmp_path / "mov"))
    t = type(t)(t.members, t.accounts, t.cards, hot, t.interactions)
    plain = sorted(map(str, flat.build(t).collect()))
    confs(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4k",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="1k",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="8k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
    )
    for build in (flat.build, lambda x: star.build(x)["fato_movimentacao"]):
        df = build(t)
        df.write.format("noop").mode("overwrite").save()
        rows = df.collect()
        text = df._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"SortMergeJoin\(skew=true\) \[id_cartao", text), text[:3000]
        if build is flat.build:
            assert sorted(map(str, rows)) == plain


def test_a_group_of_copies_is_collapsed_before_the_shuffle(spark):
    """A third of the rows are copies of one row; each task passes one of them on."""
    rows = spark.range(0, 9000, 1, 6).select(
        F.col("id").cast("int").alias("id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
    )
    kept = reload.first_per_key(rows, ["k"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan
    assert kept.count() == 6001
    assert kept.where("k = 0").first().id == 0
